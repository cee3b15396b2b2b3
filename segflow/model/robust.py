"""Linear model with the reported loss: Huber's with a fixed bend."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.model.data import INPUTS, SCORE, fit_scaler
from segflow.model.regress import LinearScorer
from segflow.schema import TARGET
from segflow.session import stored

#: Fixed value: the bend of the reported loss, in vehicles an hour.
BEND = 500.0


def fit_huber(
    train: DataFrame,
    features: list[str],
    target: str = TARGET,
    bend: float = BEND,
    rounds: int = 50,
    tolerance: float = 1e-9,
    history: list[LinearScorer] | None = None,
) -> LinearScorer:
    """Least squares, reweighted until every weight changes by less than ``tolerance`` times the
    largest; rows with an error beyond the bend count by bend over error.

    A round is one pass: the sums of products of the features, weighted, are added up in
    tasks and solved on the driver, features squared in size. The inputs are stored once. Rows
    without a target are left out. ``history`` gets the model of every round.
    """
    scaler = fit_scaler(train, features)
    rows = scaler.inputs(train).select(INPUTS, F.col(target).cast("double").alias("_y")).where("_y is not null")
    rows = stored(rows, "huber").withColumn("_vector", array_to_vector(F.col(INPUTS)))
    learner = LinearRegression(featuresCol="_vector", labelCol="_y", weightCol="_weight", solver="normal", regParam=0.0, standardization=False)
    model = None
    for _ in range(rounds):
        error = F.abs(F.col("_y") - F.col(SCORE))
        weight = F.lit(1.0) if model is None else F.when(error <= bend, 1.0).otherwise(bend / error)
        weighted = (rows if model is None else model.score_inputs(rows)).withColumn("_weight", weight)
        fitted = learner.fit(weighted.select("_vector", "_y", "_weight"))
        last, model = model, LinearScorer(scaler, list(fitted.coefficients), fitted.intercept)
        if history is not None:
            history.append(model)
        if last is not None:
            now, before = ([*m.weights, m.intercept] for m in (model, last))
            if max(abs(a - b) for a, b in zip(now, before)) < tolerance * max(1.0, *map(abs, now)):
                break
    return model

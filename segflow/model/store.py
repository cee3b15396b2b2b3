"""A model folder: the kind of model, its scaler and weights, and the category codes
that its training rows had. What is scored later needs the same codes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from segflow.model.network import NetworkScorer
from segflow.model.regress import LinearScorer, TreeScorer, VolumeModel

KINDS = {"linear": LinearScorer, "trees": TreeScorer, "network": NetworkScorer}


@dataclass
class Trained:
    """A model and its category codes (:func:`segflow.functions.codes.category_index`)."""

    model: VolumeModel
    index: DataFrame


def save_model(spark: SparkSession, trained: Trained, path: str) -> None:
    """Write all parts below ``path``. The kind comes last: a folder without it is not
    a whole model."""
    kind = next(k for k, c in KINDS.items() if isinstance(trained.model, c))
    trained.model.save(spark, path)
    trained.index.write.mode("overwrite").parquet(f"{path}/categories")
    spark.createDataFrame([(kind,)], "kind string").coalesce(1).write.mode("overwrite").parquet(f"{path}/kind")


def load_model(spark: SparkSession, path: str) -> Trained:
    kind = spark.read.parquet(f"{path}/kind").first().kind
    return Trained(KINDS[kind].load(spark, path), spark.read.parquet(f"{path}/categories"))

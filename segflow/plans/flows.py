"""The whole way from files to results: match, generate, train, predict, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from segflow.functions.codes import category_index
from segflow.model.data import split
from segflow.model.importance import log_row, permutation_importance
from segflow.model.network import Settings, fit_network
from segflow.model.regress import BestModel, VolumeModel, best_of, evaluate, fit_linear, fit_trees
from segflow.model.store import Trained, load_model, save_model
from segflow.plans import conflate as join
from segflow.plans.evaluate import accuracy_table, peak_table
from segflow.plans.features import feature_table
from segflow.plans.report import dataset_year
from segflow.schema import DENSITY_COLUMNS, MATCH, TARGET, feature_columns
from segflow.session import size_shuffle, stored
from segflow.sources import parts, readers, writers

#: Columns that tell the rows of a feature table apart.
ROW_KEY = ["tmc_code", "TMC_Value", "DIR", "measurement_tstamp"]


@dataclass(frozen=True)
class Sources:
    """Paths of the input files. A dataset for training also needs ``matches``
    and ``counts``."""

    probe_all: str
    probe_pass: str
    probe_truck: str
    segments: str
    matches: str | None = None
    counts: str | None = None

    def require(self, training: bool) -> None:
        optional = set() if training else {"matches", "counts"}
        missing = [f.name for f in fields(self) if not getattr(self, f.name) and f.name not in optional]
        if missing:
            raise ValueError(f"missing sources: {', '.join(missing)}")


def match_files(
    spark: SparkSession, shapes: str, stations: str, output: str, n: int | None = None, parity: bool = False
) -> DataFrame:
    """Match stations to segments; write the match file ``<output>.csv`` and
    the plain id list ``<output>_pure``; return the stored matches."""
    picked = join.pick_stations(readers.stations(spark, stations), n, parity)
    size_shuffle(spark, [shapes, stations])
    found = stored(join.match_stations(readers.shapes(spark, shapes), picked), "matches")
    writers.write_table(found, f"{output}.csv")
    writers.write_ids(found, f"{output}_pure")
    return found


def generate(spark: SparkSession, sources: Sources, output: str, training: bool) -> DataFrame:
    """Join the sources into a dataset at ``output`` (Parquet). For training it is also
    written by station and year to ``<output>_stations``; a later run replaces only the stations
    it has."""
    sources.require(training)
    paths = [sources.probe_all, sources.probe_pass, sources.probe_truck]
    size_shuffle(spark, paths)
    probes = [readers.probe(spark, p) for p in paths]
    segments = readers.segments(spark, sources.segments)
    if training:
        matches = stored(readers.matches(spark, sources.matches), "matches")
        joined = join.conflate(*probes, segments, matches, readers.counts(spark, sources.counts))
    else:
        joined = join.conflate(*probes, segments)
    writers.write_table(joined, output)
    dataset = readers.dataset(spark, output)
    if training:
        year = dataset_year(dataset).first().dataset_year
        parts.write_stations(dataset, f"{output}_stations", year)
    return dataset


def hold_out_matches(spark: SparkSession, matches: str, trained: list[str], output: str) -> tuple[int, DataFrame]:
    """Write the matches of stations without a file in the ``trained`` dataset
    folders to ``output``; return the rows kept and the stations taken out."""
    table = readers.read_csv(spark, matches, MATCH)
    kept, removed = join.hold_out(table, readers.stations_of_folders(spark, trained))
    writers.write_table(kept.select(*MATCH.names), output)
    return readers.read_csv(spark, output, MATCH).count(), removed


Learner = Callable[[DataFrame, list[str], str], VolumeModel]


def _prepare(dataset: DataFrame, target: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Category codes, training rows and test rows, from stored tables."""
    index = stored(category_index(dataset, DENSITY_COLUMNS), "categories")
    table = stored(feature_table(dataset, index=index), "features")
    return index, *split(table, [*ROW_KEY, target])


def _log_importance(model: VolumeModel, test: DataFrame, target: str, epoch: int, output: str) -> None:
    parts.write_importance(log_row(permutation_importance(model, test, target), epoch), f"{output}_featureimportance")


def _keep(spark: SparkSession, best: BestModel, index: DataFrame, output: str, settings: dict) -> None:
    save_model(spark, Trained(best.model, index), f"{output}.model")
    measures = {"model_R2": best.r2, "model_within_percent": best.pct_within, "model_top_loss": best.loss}
    writers.write_run(spark, settings | {"model": type(best.model).__name__} | measures, f"{output}_params")


def train(
    spark: SparkSession,
    dataset: DataFrame,
    output: str,
    learners: list[Learner] = (fit_linear, fit_trees),
    features: list[str] | None = None,
    target: str = TARGET,
) -> tuple[BestModel, DataFrame]:
    """Fit the learners on nine tenths of the rows and keep the best by the
    other tenth. Below ``output`` go the model, the category codes, the run
    settings and the importance of the features. Returns the best model and its
    measures on the test rows."""
    features = features or feature_columns()
    index, train_rows, test_rows = _prepare(dataset, target)
    best = best_of([fit(train_rows, features, target) for fit in learners], test_rows, target)
    _log_importance(best.model, test_rows, target, 1, output)
    _keep(spark, best, index, output, {"features": features, "target": target})
    return best, evaluate(best.model, test_rows, target)


def train_network(
    spark: SparkSession,
    dataset: DataFrame,
    output: str,
    settings: Settings = Settings(),
    features: list[str] | None = None,
    target: str = TARGET,
) -> tuple[BestModel, list[tuple[int, float]]]:
    """As :func:`train`, with the network: importance is logged at every test
    epoch, and a new best is stored at once with its measures. Returns the best model
    and the mean loss of each epoch that ran. A run that was cut short goes on from its
    last test epoch, which ``<output>_progress`` holds, when it is started again."""
    features = features or feature_columns()
    index, train_rows, test_rows = _prepare(dataset, target)
    described = {"features": features, "target": target} | asdict(settings)

    def on_test(epoch: int, model: VolumeModel, best: BestModel) -> None:
        _log_importance(model, test_rows, target, epoch, output)
        if best.model is model:
            _keep(spark, best, index, output, described | {"epoch": epoch})

    best, losses = fit_network(train_rows, test_rows, features, target, settings, on_test, f"{output}_progress")
    _keep(spark, best, index, output, described)
    return best, losses


def predict(dataset: DataFrame, trained: Trained, parity: bool = False) -> DataFrame:
    """The dataset with a predicted volume: one row for each of its rows that has all
    features. Category codes are those of the training rows, so a dataset that lacks a
    category does not shift the others. ``parity=True`` finds the raw rows by a join on
    segment and hour instead, and multiplies where several share them."""
    if parity:
        table = feature_table(dataset, index=trained.index)
        return join.merge_predictions(dataset, trained.model.predict(table), parity)
    return join.beside_raw(trained.model.predict(feature_table(dataset, index=trained.index, carry=True)))


def predict_files(spark: SparkSession, dataset: str, model: str, folder: str, name: str) -> DataFrame:
    """Predict a stored dataset with a stored model; write ``<name>_predictions`` to
    ``folder``."""
    rows = predict(readers.dataset(spark, dataset), load_model(spark, model))
    writers.write_predictions(rows, folder, name)
    return spark.read.parquet(f"{folder}/{name}_predictions.parquet")


def results(predictions: DataFrame) -> DataFrame:
    """Display rows: accuracy where counts are known, else the peaks."""
    return accuracy_table(predictions) if TARGET in predictions.columns else peak_table(predictions)

"""Named queries over a data folder: one per operator.

Each query derives its traffic tables from the given tables (see
:mod:`segflow.standins`), runs the operator over all of their rows and rounds
computed doubles, so that results can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow import schema
from segflow.checks import FEATURE_KEY, fixed_weights
from segflow.functions.codes import category_index, direction_code, encode_categories, segment_number, segment_variant
from segflow.functions.shapes import vertices
from segflow.functions.times import count_timestamp, epoch_seconds, with_calendar
from segflow.model.data import SCORE, fit_scaler, split
from segflow.model.importance import permutation_importance as feature_importance
from segflow.model.network import Settings, first_step
from segflow.model.regress import LinearScorer, VolumeModel, evaluate as evaluate_model, evaluate_many, fit_linear, fit_trees
from segflow.model.robust import fit_huber
from segflow.operators.histograms import fixed_width_histogram
from segflow.operators.neighbours import with_hour_neighbours, with_neighbours
from segflow.operators.rank import first_per_key, in_test_share
from segflow.operators.tables import coerce_numeric, drop_blank, lost_ids, repair_codes, union_all, union_ids
from segflow.plans import conflate as join
from segflow.plans import evaluate, features, report
from segflow.session import configure, scratch_path, stored
from segflow.sources import parts, readers, writers
from segflow.standins import StandIns

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_PROBE = ["tmc_code", "measurement_tstamp", "speed", "travel_time_seconds", "data_density"]


def query(build: Callable[[StandIns], DataFrame]) -> Callable[[StandIns], DataFrame]:
    """Register a function from stand-in tables to a result under its name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(StandIns(configure(spark), folder))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"}
    return df.withColumns(doubles) if doubles else df


# ---- shared inputs ----------------------------------------------------------


def _segments(t: StandIns) -> DataFrame:
    return readers.as_segments(t.segment_id)


def _probes(t: StandIns) -> DataFrame:
    return join.combine_probe(t.probe_all, t.probe_pass, t.probe_truck)


def _tier1(t: StandIns) -> DataFrame:
    return join.match_stations(t.shape, join.pick_stations(t.station))


def _stored_tier1(t: StandIns) -> DataFrame:
    return _shared(t, "matches", _tier1)


def _matches(t: StandIns) -> DataFrame:
    return readers.as_matches(_stored_tier1(t))


def _dataset(t: StandIns) -> DataFrame:
    return join.conflate(
        t.probe_all, t.probe_pass, t.probe_truck, _segments(t).drop("active_start_date"), _matches(t),
        readers.as_counts(t.count_hourly).drop("count_county"),
    )


#: Tables that several queries start from, by application and folder.
_SHARED: dict[tuple[str, str, str], DataFrame] = {}


def _shared(t: StandIns, name: str, build: Callable[[StandIns], DataFrame]) -> DataFrame:
    """A table that is built and stored once for each application and folder; anew if
    its files are gone."""
    sc = t.spark.sparkContext
    key = (sc.applicationId, t.folder, name)
    known = _SHARED.get(key)
    if known is not None:
        place = sc._jvm.org.apache.hadoop.fs.Path(known.inputFiles()[0]) if known.inputFiles() else None
        if place is not None and place.getFileSystem(sc._jsc.hadoopConfiguration()).exists(place):
            return known
    _SHARED[key] = stored(build(t), name)
    return _SHARED[key]


def _stored_dataset(t: StandIns) -> DataFrame:
    return _shared(t, "dataset", _dataset)


def _features(t: StandIns) -> DataFrame:
    return _shared(t, "features", lambda t: features.feature_table(_stored_dataset(t)))


def _stored(t: StandIns, df: DataFrame, name: str) -> str:
    """Write a table as CSV into the shared scratch folder; the path."""
    path = scratch_path(df.sparkSession, name)
    writers.write_table(df, f"{path}.csv")
    return f"{path}.csv"


# ---- sources ----------------------------------------------------------------


@query
def scan_counts(t):
    source = t.count_file
    return readers.raw_counts(source.sparkSession, _stored(t, source, "counts"))


@query
def scan_cached(t):
    """Three versions of a folder of count files, scanned one after the other: the second
    changes every other month, the third lacks a file of the first."""
    source, spark = t.count_file, t.spark
    folder, cache = scratch_path(spark, "counts"), scratch_path(spark, "cache")
    wrong = source.withColumn("VOL", F.col("VOL") + F.col("MONTH") % 2)
    for part, rows in (("even", wrong.where("MONTH % 2 = 0")), ("odd", wrong.where("MONTH % 2 = 1")), ("old", wrong)):
        writers.write_table(rows, f"{folder}/{part}.csv")
    parts.cached_scan(spark, folder, cache).count()
    writers.write_table(source.where("MONTH % 2 = 1"), f"{folder}/odd.csv")
    parts.cached_scan(spark, folder, cache).count()
    writers.delete(spark, f"{folder}/old.csv")
    return parts.cached_scan(spark, folder, cache)


@query
def station_parts(t):
    """Stations of a dataset folder after every other one was written anew."""
    rows, folder = t.count_hourly.withColumnRenamed("STATE_NAME", "state").drop("YEAR"), scratch_path(t.spark, "stations")
    parts.write_stations(rows.withColumn("VOL", F.lit(0.0)), folder, "2024")
    parts.write_stations(rows.where("cast(STATION_ID as int) % 2 = 0"), folder, "2024")
    return readers.dataset_folder(t.spark, folder)


@query
def scan_probe(t):
    source = t.probe_all
    return readers.probe(source.sparkSession, _stored(t, source, "probe"))


@query
def scan_segments(t):
    source = t.segment_id
    stored = readers.segments(source.sparkSession, _stored(t, source, "segments"))
    return stored.drop("road", "intersection")


@query
def wkt_vertices(t):
    return rounded(vertices(t.shape, "geometry", ["Tmc"]))


@query
def union_datasets(t):
    return union_all([t.probe_pass.drop("travel_time_seconds"), t.probe_truck.drop("data_density")])


@query
def tmc_id_list(t):
    return _tier1(t).select("Tmc")


@query
def tmc_id_text(t):
    return writers.joined_ids(_stored_tier1(t), "Tmc", ["Tmc", "STATION_ID", "DIR"], per_line=100)


# ---- projections and filters ------------------------------------------------


@query
def combine_probe_legacy(t):
    return join.combine_probe_legacy(t.probe_all, t.probe_pass, t.probe_truck)


@query
def filter_county(t):
    return join.in_county(t.count_hourly, "STATE_1", "County 1")


@query
def filter_states(t):
    return report.in_states(t.predictions, "state", ["STATE_1", "STATE_3"])


@query
def segments_in_state(t):
    rows = report.segments_where(join.attach_segments(t.probe_all, _segments(t)), "state", "STATE_2")
    return rows.select("tmc_code", "measurement_tstamp", "state", "speed")


@query
def segments_in_county(t):
    rows = report.segments_where(join.attach_segments(t.probe_all, _segments(t)), "county", "County 3")
    return rows.select("tmc_code", "measurement_tstamp", "county", "speed")


@query
def segment_rows(t):
    return report.segment_rows(t.probe_all, "104N00007")


@query
def segments_in_range(t):
    return report.segments_between(t.probe_all, datetime(2024, 1, 5, 6), datetime(2024, 1, 12, 18))


@query
def drop_blank_state(t):
    return drop_blank(t.shape, "State").select("Tmc", "State")


@query
def repair_codes_query(t):
    fixed = repair_codes(t.predictions, "104.00012", "00012", "00011", 3)
    return fixed.select("tmc_code", "measurement_tstamp", "DIR", "VOL")


QUERIES["repair_codes"] = QUERIES.pop("repair_codes_query")


@query
def coerce_numeric_query(t):
    rows = t.sql(
        "select event_id, event_type, case when event_id%10 = 0 then 'n/a' else cast(user_id as string) end as user_text "
        "from events"
    )
    return coerce_numeric(rows, ["event_type", "user_text"])


QUERIES["coerce_numeric"] = QUERIES.pop("coerce_numeric_query")


@query
def segment_day(t):
    return report.segment_day(t.probe_all, "104P00003", date(2024, 1, 10))


# ---- joins ------------------------------------------------------------------


@query
def combine_probe(t):
    return _probes(t)


@query
def attach_segments(t):
    return join.attach_segments(_probes(t), _segments(t).drop("active_start_date"))


@query
def attach_stations(t):
    rows = join.attach_stations(_probes(t), _matches(t), _segments(t))
    return rows.select(
        "tmc_code", "measurement_tstamp", "STATION_ID", "station_lat", "station_long", "tier", "DIR", "state", "aadt",
        "speed_All", "speed_Pass", "speed_Truck",
    )


@query
def conflate(t):
    return _dataset(t)


@query
def conflate_inference(t):
    rows = join.conflate(t.probe_all, t.probe_pass, t.probe_truck, _segments(t))
    return rows.select("tmc_code", "measurement_tstamp", "speed_All", "data_density_Truck", "DIR", "state", "aadt")


@query
def conflate_legacy(t):
    located = join.attach_stations(_probes(t), _matches(t), _segments(t))
    counts = readers.as_counts(t.count_hourly)
    rows = join.attach_counts_legacy(located, counts, "STATE_1", "County 1")
    return rows.select("tmc_code", "measurement_tstamp", "STATION_ID", "DIR", "state", "speed_All", "VOL")


@query
def geo_match(t):
    pairs = join.near_stations(t.shape, join.pick_stations(t.station))
    return pairs.select(
        "Tmc", "STATION_ID", "STATE_NAME", "dir_num", "station_dir", "shape_class", "station_class", "LAT", "LONG"
    )


@query
def geo_tier1(t):
    return _tier1(t)


_MERGED = [
    "tmc_code_raw", "tmc_code", "TMC_Value", "measurement_tstamp", "DIR", "STATION_ID", "VOL_raw", "VOL_norm",
    "hour", "speed_All_raw", "speed_All_before", "Predicted_VOL",
]


def _merged(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("hour_norm", "hour").select(*_MERGED)


def _scored(rows: DataFrame) -> DataFrame:
    return rows.withColumn("Predicted_VOL", F.floor(F.col("aadt") / 100.0 + F.col("speed_All")).cast("int"))


@query
def merge_predictions(t):
    return _merged(join.merge_predictions(_stored_dataset(t), _scored(_features(t))))


@query
def score_in_place(t):
    carried = features.feature_table(_stored_dataset(t), carry=True)
    return _merged(join.beside_raw(_scored(carried)))


def _trained(t: StandIns) -> DataFrame:
    """Stations that have a file in the training dataset."""
    named = t.dataset_file.select(readers.station_of_file(F.col("file_name")).alias("STATION_ID"))
    return union_ids([named], "STATION_ID")


@query
def holdout_anti(t):
    return join.hold_out(_tier1(t), _trained(t))[0].select("Tmc", "STATION_ID", "DIR", "tier")


@query
def holdout_removed(t):
    return join.hold_out(_tier1(t), _trained(t))[1]


@query
def attach_counties(t):
    name = F.concat("county", F.lit(", "), F.initcap(F.translate("state", "_", " ")))
    rows = _segments(t).withColumn("county_name", name)
    return join.attach_counties(rows, t.county_population, "county_name").select("tmc_code", "county", "county_population")


@query
def find_counties(t):
    """Segments with the first county whose name contains a part of theirs."""
    part = F.when(F.col("f_system") % 3 == 0, F.upper("county")).when(F.col("f_system") % 3 == 1, F.concat(F.substring("county", 7, 9), F.lit(", s"))).otherwise(F.lit("no such"))
    rows = _segments(t).select("tmc_code", part.alias("part"))
    return join.find_counties(rows, t.county_population, "part")


@query
def top_stations(t):
    return report.top_stations(t.predictions).select("STATION_ID", "VOL", "state", "tmc_code", "measurement_tstamp")


@query
def county_lookup(t):
    return join.county_population(t.county_population, "COUNTY 7")


# ---- aggregates -------------------------------------------------------------


@query
def station_counts(t):
    return report.station_counts(t.predictions)


@query
def availability_month(t):
    return report.availability_long(readers.as_counts(t.count_hourly))


@query
def availability_hour(t):
    return report.availability_by_hour(readers.as_counts(t.count_hourly))


@query
def distinct_stations(t):
    return report.distinct_stations(t.count_hourly)


@query
def available_stations(t):
    return report.available_stations(t.count_hourly)


@query
def join_coverage(t):
    return report.join_coverage(t.probe_all, _dataset(t))


@query
def hourly_by_weekday(t):
    return rounded(report.hourly_by_weekday(t.predictions))


@query
def station_max(t):
    return report.station_max(t.predictions)


@query
def volume_histogram(t):
    return rounded(report.volume_histogram(t.predictions))


@query
def station_max_histogram(t):
    return rounded(report.station_max_histogram(t.predictions))


@query
def worst_zero_histogram(t):
    return rounded(report.volume_histogram(evaluate.worst_zero_rows(t.predictions)))


@query
def error_histogram(t):
    return fixed_width_histogram(evaluate.error_values(t.predictions), "percent_error", 10, 300)


@query
def error_histogram_fine(t):
    every = t.predictions.select(evaluate.percent_difference().alias("percent_error"))
    return fixed_width_histogram(every, "percent_error", 5, 150)


@query
def dataset_year(t):
    return report.dataset_year(t.probe_all)


@query
def accuracy_metrics(t):
    return rounded(evaluate.accuracy(t.predictions))


@query
def within_thresholds(t):
    return rounded(evaluate.within_thresholds(t.predictions))


@query
def within_thresholds_50(t):
    return rounded(evaluate.within_thresholds(t.predictions, evaluate.HOLD_OUT_THRESHOLDS))


@query
def zero_share(t):
    both = [evaluate.zero_share(t.predictions, c).withColumn("col", F.lit(c)) for c in ("VOL", "Predicted_VOL")]
    return rounded(union_all(both))


@query
def zero_share_summary(t):
    both = [evaluate.zero_share_summary(t.predictions, c).withColumn("col", F.lit(c)) for c in ("VOL", "Predicted_VOL")]
    return rounded(union_all(both))


@query
def peak_metrics(t):
    return rounded(evaluate.peaks(t.predictions))


@query
def max_error_row(t):
    return evaluate.largest_error(t.predictions)


@query
def hour_profile(t):
    day = report.segment_day(t.predictions, "104P00003", date(2024, 1, 10))
    return rounded(evaluate.hour_profile(day, ["VOL", "Predicted_VOL"]))


@query
def volume_quintile(t):
    return evaluate.volume_quintile(t.predictions).select("tmc_code", "measurement_tstamp", "VOL", "quintile")


@query
def r2_within(t):
    return rounded(evaluate.fit_quality(t.predictions))


@query
def huber_loss(t):
    return rounded(evaluate.huber_loss(t.predictions))


@query
def sanity_report(t):
    return report.sanity(t.probe_all, ["speed", "travel_time_seconds", "data_density"])


@query
def importance_mean(t):
    return rounded(report.importance_mean(report.importance_long(t.importance_log)))


# ---- windows ----------------------------------------------------------------


@query
def neighbour_features(t):
    rows = join.attach_segments(t.probe_all, _segments(t))
    rows = features.code_step(rows).withColumn("measurement_tstamp", F.unix_timestamp("measurement_tstamp"))
    shifted = ["measurement_tstamp", "speed", "travel_time_seconds"]
    rows = rows.select(*features.SERIES, *shifted)
    return with_neighbours(rows, features.SERIES, "measurement_tstamp", shifted)


@query
def neighbour_hours(t):
    """Values of the hours just before and after; hours without a row are gaps."""
    rows = join.attach_segments(t.probe_truck, _segments(t))
    rows = features.code_step(rows).withColumn("measurement_tstamp", F.unix_timestamp("measurement_tstamp"))
    return with_hour_neighbours(rows.select(*features.SERIES, "measurement_tstamp", "speed"), features.SERIES, "measurement_tstamp", ["speed"])


@query
def first_per_segment(t):
    return report.first_segments(t.probe_all)


@query
def first_per_station(t):
    order = ["YEAR", "MONTH", "DAY", "HOUR"]
    rows = first_per_key(t.count_hourly, ["STATION_ID", "STATE_NAME"], order)
    return rows.select("STATION_ID", "STATE_NAME", "DIR", "VOL", *order)


# ---- sorts, samples, sets ---------------------------------------------------


@query
def importance_top10(t):
    return rounded(report.importance_top(report.importance_long(t.importance_log)))


@query
def importance_ranked(t):
    return rounded(report.importance_ranked(report.importance_long(t.importance_log)))


@query
def importance_long(t):
    return rounded(report.importance_long(t.importance_log))


@query
def distinct_segments(t):
    return report.distinct_segments(t.probe_all)


@query
def segment_dates(t):
    return report.segment_dates(t.probe_all, "104P00003")


@query
def sample_stations(t):
    return join.pick_stations(t.station, 60)


@query
def map_sample(t):
    return report.map_sample(join.attach_segments(t.probe_all, _segments(t)), keys=["measurement_tstamp"])


@query
def training_stations(t):
    return _trained(t)


@query
def missing_stations(t):
    located = join.attach_stations(_probes(t), _matches(t), _segments(t))
    return lost_ids(located, _stored_dataset(t), "STATION_ID")


# ---- scalar functions -------------------------------------------------------


@query
def segment_code(t):
    code = F.col("tmc_code")
    return t.probe_all.select(
        code.alias("tmc_code_raw"), segment_variant(code).alias("TMC_Value"), segment_number(code).alias("tmc_code")
    ).distinct()


@query
def calendar_features(t):
    return with_calendar(t.probe_all).select("tmc_code", "measurement_tstamp", *schema.CALENDAR_COLUMNS)


@query
def startdate_epoch(t):
    return t.segment_id.select("tmc", epoch_seconds(F.col("active_start_date")).alias("active_start_date"))


@query
def density_codes(t):
    rows = t.probe_all.select("tmc_code", "measurement_tstamp", "data_density")
    return encode_categories(rows, ["data_density"], category_index(rows, ["data_density"]))


@query
def direction_code_query(t):
    return t.segment_id.select("tmc", "direction", direction_code(F.col("direction")).alias("DIR"))


QUERIES["direction_code"] = QUERIES.pop("direction_code_query")


@query
def count_timestamp_query(t):
    parts = [F.col(c) for c in ("YEAR", "MONTH", "DAY", "HOUR")]
    return t.count_hourly.select("STATION_ID", "VOL", count_timestamp(*parts).alias("measurement_tstamp"))


QUERIES["count_timestamp"] = QUERIES.pop("count_timestamp_query")


# ---- display ----------------------------------------------------------------


@query
def metrics_table(t):
    return evaluate.accuracy_table(t.predictions)


@query
def peak_table(t):
    return evaluate.peak_table(t.predictions)


@query
def hold_out_table(t):
    return evaluate.hold_out_table(t.predictions)


# ---- model tables -----------------------------------------------------------


@query
def feature_table(t):
    return _features(t)


@query
def split_rows(t):
    return _features(t).select(*FEATURE_KEY, in_test_share(*FEATURE_KEY).alias("test"))


@query
def standardise(t):
    train, test = split(_features(t), FEATURE_KEY)
    scaler = fit_scaler(train, schema.feature_columns())
    return rounded(scaler.apply(train.unionByName(test)).select("row_hash", *schema.feature_columns()))


def _train_and_test(t: StandIns) -> tuple[DataFrame, DataFrame]:
    return split(_features(t), FEATURE_KEY)


def _fixed(train: DataFrame) -> VolumeModel:
    weights = fixed_weights()
    return LinearScorer(fit_scaler(train, list(weights)), list(weights.values()))


@query
def permutation_importance(t):
    train, test = _train_and_test(t)
    return rounded(feature_importance(_fixed(train), test), 4)


@query
def evaluate_fixed(t):
    train, test = _train_and_test(t)
    return rounded(evaluate_model(_fixed(train), test))


def _predicted(model: VolumeModel, test: DataFrame) -> DataFrame:
    keys = [c for c in FEATURE_KEY if c != schema.TARGET]
    return model.predict(test).select("row_hash", *keys, schema.PREDICTION)


@query
def fit_predict_linear(t):
    train, test = _train_and_test(t)
    return _predicted(fit_linear(train, schema.feature_columns()), test)


@query
def fit_predict_trees(t):
    train, test = _train_and_test(t)
    return _predicted(fit_trees(train, schema.feature_columns()), test)


@query
def network_step(t):
    """One optimiser step of the published network over all training rows: size of the
    gradient by kind and layer of its numbers."""
    train, _ = _train_and_test(t)
    settings = Settings()
    sizes = first_step(train, schema.feature_columns(), settings)
    return train.sparkSession.createDataFrame(sizes, "kind string, layer int, numbers long, loss double, slope double")


#: Two inputs keep the check, which solves the equations in SQL, short.
HUBER = {"features": ["aadt", "speed_All"], "bend": 20.0, "rounds": 5, "tolerance": 0.0}


@query
def huber_rounds(t):
    """Weights of a robust linear model after every round."""
    train, _ = _train_and_test(t)
    models: list[LinearScorer] = []
    fit_huber(train, history=models, **HUBER)
    rows = [(i, name, w) for i, m in enumerate(models, 1) for name, w in zip(["intercept", *HUBER["features"]], [m.intercept, *m.weights])]
    return rounded(t.spark.createDataFrame(rows, "round int, input string, weight double"))


@query
def evaluate_huber(t):
    """Measures of robust linear models by the number of rounds, from one pass over the test rows."""
    train, test = _train_and_test(t)
    models: list[LinearScorer] = []
    fit_huber(train, history=models, **HUBER)
    return rounded(evaluate_many(models, test))


@query
def fit_predict_huber(t):
    train, test = _train_and_test(t)
    scored = fit_huber(train, **HUBER).score(test)
    return rounded(scored.select(*FEATURE_KEY, F.col(SCORE).alias("score")), 4)


@query
def evaluate_linear(t):
    train, test = _train_and_test(t)
    return evaluate_model(fit_linear(train, schema.feature_columns()), test)

"""Availability, coverage, distribution and selection reports."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.operators.histograms import equal_width_histogram
from segflow.operators.rank import first_per_key, sample_by_hash
from segflow.operators.tables import complete_rows, to_long

#: Parts of the names that published logs use for empty and neighbour columns.
_PLACEHOLDERS = "before|after|feature"


# ---- availability -----------------------------------------------------------


def station_counts(df: DataFrame) -> DataFrame:
    """Hours with data per station."""
    named = df.where("STATION_ID is not null")
    return named.groupBy("STATION_ID").agg(F.count("measurement_tstamp").alias("n"))


def availability(df: DataFrame, column: Column, values: list, prefix: str) -> DataFrame:
    """Stations × values of ``column``, hours with data in each cell, 0 where
    there are none. The values are given, so no extra pass has to find them."""
    hits = [F.count(F.when(column == v, F.col("measurement_tstamp"))).alias(f"{prefix}{v}") for v in values]
    return df.where("STATION_ID is not null").groupBy("STATION_ID").agg(*hits)


def availability_by_month(df: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Hours per station and (year, month); months as in the count file."""
    key = F.col("YEAR") * 100 + F.col("MONTH")
    return availability(df, key, [y * 100 + m for y, m in months], "m")


def availability_long(df: DataFrame) -> DataFrame:
    """Hours per station and month that have data, as rows: ``STATION_ID``, ``YEAR``,
    ``MONTH``, ``n``. Nothing has to be known of the months beforehand, and stations by
    months may be any number. A missing year or month is a month of its own."""
    named = df.where("STATION_ID is not null")
    return named.groupBy("STATION_ID", "YEAR", "MONTH").agg(F.count("measurement_tstamp").alias("n"))


def availability_by_hour(df: DataFrame) -> DataFrame:
    """Hours per station and hour of the day."""
    return availability(df, F.col("HOUR"), list(range(24)), "h")


def months_present(df: DataFrame) -> list[tuple[int, int]]:
    """(year, month) pairs in the data, sorted: a dozen per year."""
    return sorted(tuple(r) for r in df.select("YEAR", "MONTH").where("YEAR is not null").distinct().collect())


# ---- coverage ---------------------------------------------------------------


def distinct_stations(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("STATION_ID").alias("stations"))


def available_stations(df: DataFrame) -> DataFrame:
    """Distinct (station, state) pairs, sorted."""
    pairs = complete_rows(df.select("STATION_ID", "STATE_NAME")).distinct()
    return pairs.orderBy("STATION_ID", "STATE_NAME")


def key_counts(df: DataFrame, label: str) -> DataFrame:
    """Distinct segments and distinct (segment, hour) pairs of a table. Pairs
    are reduced first, then counted per segment: one shuffle of distinct pairs
    instead of one copy of the table per distinct count."""
    pairs = df.select("tmc_code", "measurement_tstamp").where("tmc_code is not null").distinct()
    per_segment = pairs.groupBy("tmc_code").agg(F.count("measurement_tstamp").alias("n"))
    return per_segment.agg(
        F.lit(label).alias("side"),
        F.count("*").alias("segments"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("segment_hours"),
    )


def join_coverage(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct keys before and after a join."""
    return key_counts(before, "before").unionByName(key_counts(after, "after"))


def dataset_year(df: DataFrame) -> DataFrame:
    """``2022`` for a dataset of one year, ``20212022`` for one from 2021 to 2022."""
    first, last = F.min(F.year("measurement_tstamp")), F.max(F.year("measurement_tstamp"))
    tag = F.when(first == last, first.cast("string")).otherwise(F.concat(first.cast("string"), last.cast("string")))
    return df.agg(tag.alias("dataset_year"))


def sanity(df: DataFrame, features: list[str]) -> DataFrame:
    """One row: rows with a null, rows with an infinite value, and rows that
    repeat the features of another. Copies are counted before the shuffle."""
    distinct = df.groupBy(*features).agg(F.count("*").alias("_copies"))
    numeric = [f for f, kind in df.dtypes if f in features and kind in ("double", "float")]
    null_row = F.lit(False)
    for f in features:
        null_row = null_row | F.col(f).isNull()
    infinite = F.lit(False)
    for f in numeric:
        infinite = infinite | F.coalesce(F.abs(F.col(f)) == float("inf"), F.lit(False))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return distinct.agg(
        total(F.col("_copies")).alias("n_rows"),
        total(F.when(null_row, F.col("_copies"))).alias("rows_with_null"),
        total(F.when(infinite, F.col("_copies"))).alias("rows_with_infinite"),
        total(F.col("_copies") - 1).alias("duplicate_rows"),
    )


# ---- distributions ----------------------------------------------------------


def hourly_by_weekday(df: DataFrame) -> DataFrame:
    """Mean volume by weekday (Monday 0) and hour."""
    ts = F.col("measurement_tstamp")
    return df.groupBy(F.weekday(ts).alias("dayofweek"), F.hour(ts).alias("hour")).agg(F.avg("VOL").alias("avg_vol"))


def station_max(df: DataFrame) -> DataFrame:
    return df.where("STATION_ID is not null").groupBy("STATION_ID").agg(F.max("VOL").alias("max_vol"))


def volume_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return equal_width_histogram(df, "VOL", bins)


def station_max_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return equal_width_histogram(station_max(df), "max_vol", bins)


def top_stations(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest rows among those at their station's maximum."""
    peak = station_max(df).withColumnRenamed("max_vol", "VOL")
    rows = df.join(peak, ["STATION_ID", "VOL"])
    return rows.orderBy(F.desc("VOL"), "STATION_ID", "measurement_tstamp", "tmc_code").limit(n)


# ---- selections -------------------------------------------------------------


def first_segments(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per segment: the earliest (or first by another order)."""
    return first_per_key(df, ["tmc_code"], order or ["measurement_tstamp"])


def segments_where(df: DataFrame, column: str, value: str, order: list[str] | None = None) -> DataFrame:
    """One row per segment of a state or county."""
    return first_segments(df.where(F.col(column) == value), order)


def segment_rows(df: DataFrame, tmc_code: str) -> DataFrame:
    return df.where(F.col("tmc_code") == tmc_code)


def segments_between(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """One row per segment in the half-open time range."""
    return first_segments(_between(df, start, end))


def segment_day(df: DataFrame, tmc_code: str, day: date) -> DataFrame:
    """One segment on one day; both conditions reach the file scan."""
    start = datetime(day.year, day.month, day.day)
    return _between(segment_rows(df, tmc_code), start, start + timedelta(days=1))


def _between(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    # as text, so that the session's zone applies and not that of the driver's clock
    low, high = (F.lit(t.isoformat(" ")).cast("timestamp") for t in (start, end))
    ts = F.col("measurement_tstamp")
    return df.where((ts >= low) & (ts < high))


def in_states(df: DataFrame, column: str, states: list[str]) -> DataFrame:
    """Rows of the listed states; all rows for an empty list."""
    return df.where(F.col(column).isin(states)) if states else df


def distinct_segments(df: DataFrame) -> DataFrame:
    return df.select("tmc_code").distinct().orderBy("tmc_code")


def segment_dates(df: DataFrame, tmc_code: str | None = None) -> DataFrame:
    """Sorted dates with data, of one segment or of all."""
    rows = df if tmc_code is None else segment_rows(df, tmc_code)
    return rows.select(F.to_date("measurement_tstamp").alias("day")).distinct().orderBy("day")


def map_columns(columns: list[str]) -> tuple[str, str] | None:
    """Latitude and longitude to draw: normalised, else plain, else none."""
    for suffix in ("_norm", ""):
        pair = (f"start_latitude{suffix}", f"start_longitude{suffix}")
        if set(pair) <= set(columns):
            return pair
    return None


def map_sample(df: DataFrame, n: int = 500, keys: list[str] | None = None) -> DataFrame:
    """Up to ``n`` complete rows of position and segment, pseudo-random but
    repeatable. ``keys`` should name the row; they are kept in the result."""
    pair = map_columns(df.columns)
    if pair is None:
        raise ValueError("no latitude and longitude columns")
    keys = keys or []
    rows = complete_rows(df.select(*pair, "tmc_code", *[k for k in keys if k != "tmc_code"]))
    return sample_by_hash(rows, n, ["tmc_code", *[k for k in keys if k != "tmc_code"]])


# ---- feature importance -----------------------------------------------------


def importance_long(log: DataFrame) -> DataFrame:
    """``(epoch, feature, importance)`` from the wide log."""
    return to_long(log, ["epoch"], "feature", "importance")


def latest_epoch(long: DataFrame) -> DataFrame:
    """Rows of the last epoch, without placeholders and neighbour columns."""
    last = long.agg(F.max("epoch")).scalar()
    return long.where((F.col("epoch") == last) & ~F.col("feature").rlike(_PLACEHOLDERS))


def importance_top(long: DataFrame, n: int = 10) -> DataFrame:
    """All epochs of the ``n`` features most important in the last one."""
    top = latest_epoch(long).where("importance is not null").orderBy(F.desc("importance"), "feature").limit(n)
    return long.join(top.select("feature"), "feature", "left_semi")


def importance_ranked(long: DataFrame) -> DataFrame:
    """Features of the last epoch from most to least important."""
    return latest_epoch(long).orderBy(F.desc_nulls_last("importance"), "feature")


def importance_mean(long: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` features of largest mean importance over all epochs."""
    means = long.groupBy("feature").agg(F.avg("importance").alias("mean_importance"))
    return means.where("mean_importance is not null").orderBy(F.desc("mean_importance"), "feature").limit(n)

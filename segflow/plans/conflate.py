"""Joins that turn probe, segment, station and count tables into one dataset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.functions.codes import direction_code, segment_number, segment_variant
from segflow.operators.substring import first_containing
from segflow.operators.rank import first_per_key, sample_by_hash
from segflow.operators.spatial import lines_near_points
from segflow.operators.tables import drop_blank
from segflow.schema import COUNT_KEY, DIRECTIONS, PROBE_KEY, require_columns

BUFFER = 0.001  # degrees around a station


def combine_probe(every: DataFrame, passenger: DataFrame, truck: DataFrame) -> DataFrame:
    """Inner join of the three vehicle classes on segment and hour; all other
    columns get the suffix of their class. Both joins use one key, so each
    input is shuffled once."""
    frames = []
    for df, suffix in ((every, "_All"), (passenger, "_Pass"), (truck, "_Truck")):
        require_columns(df, PROBE_KEY)
        frames.append(df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in PROBE_KEY}))
    return reduce(lambda a, b: a.join(b, PROBE_KEY), frames)


def combine_probe_legacy(every: DataFrame, passenger: DataFrame, truck: DataFrame) -> DataFrame:
    """As :func:`combine_probe`, but ``_All`` and ``_Pass`` only go on names the
    two tables share, while ``_Truck`` goes on all."""
    shared = (set(every.columns) & set(passenger.columns)) - set(PROBE_KEY)
    every = every.withColumnsRenamed({c: c + "_All" for c in shared})
    passenger = passenger.withColumnsRenamed({c: c + "_Pass" for c in shared})
    truck = truck.withColumnsRenamed({c: c + "_Truck" for c in truck.columns if c not in PROBE_KEY})
    return every.join(passenger, PROBE_KEY).join(truck, PROBE_KEY)


def attach_segments(probe: DataFrame, segments: DataFrame) -> DataFrame:
    """Probe rows with the attributes of their segment."""
    return probe.join(segments, "tmc_code")


def attach_stations(probe: DataFrame, matches: DataFrame, segments: DataFrame) -> DataFrame:
    """Probe rows with their matched stations (one row each) and segment
    attributes. The two small tables are joined first: one pass over probe."""
    return probe.join(matches.join(segments, "tmc_code"), "tmc_code")


def attach_counts(located: DataFrame, counts: DataFrame) -> DataFrame:
    """Add the hourly count of the station, in the same state and direction.
    A missing station id or direction never matches. Columns that both sides
    have outside the key are kept from the left."""
    clash = {c.lower() for c in located.columns} - {k.lower() for k in COUNT_KEY}
    extra = [c for c in counts.columns if c not in COUNT_KEY and c.lower() not in clash]
    return located.join(counts.select(*COUNT_KEY, *extra), COUNT_KEY)


def attach_counts_legacy(located: DataFrame, counts: DataFrame, state: str, county: str) -> DataFrame:
    """Older form: counts of one county, matched on station and hour only."""
    key = ["STATION_ID", "measurement_tstamp"]
    local = in_county(counts, state, county, "state", "count_county")
    clash = {c.lower() for c in located.columns} - {k.lower() for k in key}
    return located.join(local.select(*[c for c in local.columns if c in key or c.lower() not in clash]), key)


def in_county(df: DataFrame, state: str, county: str, state_column="STATE_NAME", county_column="COUNTY_NAME"):
    return df.where((F.col(state_column) == state) & (F.col(county_column) == county))


def conflate(
    every: DataFrame,
    passenger: DataFrame,
    truck: DataFrame,
    segments: DataFrame,
    matches: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The joined dataset: for prediction from probe and segments alone, for
    training with station matches and counts as well.

    All joins are inner on or below the segment code, so in training only
    matched segments can survive; each probe table is cut down to them before
    it is shuffled. ``matches`` is used by four branches of the plan: hand in a
    stored table, not the spatial join itself.
    """
    if matches is None:
        return attach_segments(combine_probe(every, passenger, truck), segments)
    usable = matches.where(F.col("STATION_ID").isNotNull())
    if counts is not None:
        segments = segments.where(F.col("DIR").isNotNull())
    places = usable.join(segments, "tmc_code")
    probe = combine_probe(*[p.join(places, "tmc_code", "left_semi") for p in (every, passenger, truck)])
    located = probe.join(places, "tmc_code")
    return located if counts is None else attach_counts(located, counts)


def pick_stations(stations: DataFrame, n: int | None = None, parity: bool = False) -> DataFrame:
    """Distinct stations, optionally a repeatable sample of ``n``. A station
    that counts in two directions is kept for both; ``parity=True`` keeps one
    row per id and state, the one of the smallest direction."""
    key = ["STATION_ID", "STATE_NAME"] if parity else ["STATION_ID", "STATE_NAME", "DIR"]
    chosen = first_per_key(stations, key, ["DIR", "LAT", "LONG", "F_SYSTEM"])
    return chosen if n is None else sample_by_hash(chosen, n, key)


def near_stations(
    shapes: DataFrame, stations: DataFrame, reach: float = BUFFER, same=(), names: dict[str, int] = DIRECTIONS
) -> DataFrame:
    """Segments and the stations within ``reach`` degrees (an exact circle).
    ``names`` are the direction texts of the shapes."""
    lines = shapes.select(
        "Tmc",
        direction_code(F.col("DIR"), names).alias("dir_num"),
        F.col("F_System").alias("shape_class"),
        F.col("County").alias("shape_county"),
        F.col("State").alias("shape_state"),
        "geometry",
    )
    points = stations.select(
        "STATION_ID", "STATE_NAME", F.col("DIR").alias("station_dir"),
        F.col("F_SYSTEM").alias("station_class"), "LAT", "LONG",
    )
    for left, right in same:
        points = points.withColumnRenamed(right, left)
    return lines_near_points(lines, points, "geometry", "LONG", "LAT", reach, [left for left, _ in same])


def match_stations(
    shapes: DataFrame, stations: DataFrame, reach: float = BUFFER, names: dict[str, int] = DIRECTIONS
) -> DataFrame:
    """Station matches: near, same direction and same road class, with
    ``tier`` 1 and without rows of blank state. Direction and class are join
    keys next to the grid cell, not a filter after the spatial test."""
    same = [("dir_num", "station_dir"), ("shape_class", "station_class")]
    found = near_stations(shapes, stations, reach, same, names).select(
        "Tmc", "STATION_ID", F.col("dir_num").alias("DIR"), "geometry", F.col("shape_county").alias("County"),
        F.col("shape_state").alias("State"), "LAT", "LONG", F.lit(1).alias("tier"),
    )
    return drop_blank(found, "State")


def hold_out(matches: DataFrame, training: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matches of stations never trained on, and the distinct ids taken out."""
    used = training.select("STATION_ID").distinct()
    kept = matches.join(used, "STATION_ID", "left_anti")
    removed = matches.select("STATION_ID").distinct().join(used, "STATION_ID", "left_semi")
    return kept, removed


def merge_predictions(raw: DataFrame, normalised: DataFrame, parity: bool = False) -> DataFrame:
    """Raw rows next to their normalised, predicted rows, found by a join. Shared
    columns get ``_raw`` and ``_norm``. The key is segment number, hour, direction and
    segment variant; ``parity=True`` leaves the variant out, so codes that differ only in
    their letter multiply. So do several stations on one segment, in either form: rows
    that carry their raw row need no join, see :func:`beside_raw`."""
    key = ["tmc_code", "measurement_tstamp", "DIR"] + ([] if parity else ["TMC_Value"])
    code = F.col("tmc_code")
    left = raw.withColumns(
        {"TMC_Value": segment_variant(code), "tmc_code_raw": code, "tmc_code": segment_number(code)}
    )
    right = normalised.withColumn("measurement_tstamp", _hour())
    shared = _shared(left.columns, right.columns, key)
    left = left.withColumnsRenamed({c: c + "_raw" for c in left.columns if c.lower() in shared})
    right = right.withColumnsRenamed({c: c + "_norm" for c in right.columns if c.lower() in shared})
    return left.join(right, key)


def beside_raw(normalised: DataFrame, raw: str = "_raw") -> DataFrame:
    """The columns of :func:`merge_predictions` from rows that carry their raw row in the
    column ``raw``: one row for each, whatever else is on its segment and hour."""
    key = ["tmc_code", "measurement_tstamp", "DIR", "TMC_Value"]
    kept = [c for c in normalised.schema[raw].dataType.names if c not in key]
    left = {**{c: F.col(raw)[c] for c in kept}, "tmc_code_raw": F.col(raw)["tmc_code"]}
    right = [c for c in normalised.columns if c not in (raw, *key)]
    shared = _shared(list(left), right, key)
    return normalised.withColumn("measurement_tstamp", _hour()).select(
        *key,
        *[value.alias(c + "_raw" if c.lower() in shared else c) for c, value in left.items()],
        *[F.col(c).alias(c + "_norm" if c.lower() in shared else c) for c in right],
    )


def _hour():
    return F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))


def _shared(left: list[str], right: list[str], key: list[str]) -> set[str]:
    """Names outside the key on both sides; names that differ only in case clash too."""
    names = [{c.lower() for c in some if c not in key} for some in (left, right)]
    return names[0] & names[1]


def attach_counties(rows: DataFrame, counties: DataFrame, name: str = "county") -> DataFrame:
    """Rows with the columns of their county, by its name without regard to case and
    outer blanks. Rows without a known county keep nulls, so none is lost; of counties
    with one name the first by name as written counts."""
    key = lambda column: F.lower(F.trim(column))
    first = first_per_key(counties.withColumn("_county", key(F.col("name"))), ["_county"], ["name", *[c for c in counties.columns if c != "name"]])
    extra = [F.col(c).alias(f"county_{c}") for c in counties.columns if c != "name"]
    return rows.withColumn("_county", key(F.col(name))).join(first.select("_county", *extra), "_county", "left").drop("_county")


def county_population(populations: DataFrame, county: str) -> DataFrame:
    """First county, by name, whose name contains the text in any case."""
    hits = populations.where(F.contains(F.lower("name"), F.lower(F.lit(county))))
    return hits.orderBy("name").limit(1)


def find_counties(rows: DataFrame, populations: DataFrame, text: str = "county") -> DataFrame:
    """Rows with the first county, by name, whose name contains their text in any case, as
    ``found_name`` and so on; :func:`county_population` for a whole column."""
    return first_containing(rows, text, populations, "name", "found_")

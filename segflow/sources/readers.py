"""Readers for every input table. Any Hadoop path works (local, s3a, …)."""

from __future__ import annotations

import csv
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segflow import schema
from segflow.functions.codes import direction_code
from segflow.functions.shapes import geometry_column
from segflow.functions.times import count_timestamp
from segflow.operators.tables import union_all, union_ids


Groups = dict[tuple[str, ...], list[str]]


def read_csv(spark: SparkSession, path: str | list[str], kind: T.StructType, groups: Groups | None = None, *extra: Column) -> DataFrame:
    """CSV with a header and a declared schema; columns the files lack are null
    and extra ones are left out. A value that does not fit its type is an error.
    ``extra`` columns, of a file's metadata say, are added.

    All files must have the header of the first one, and Spark checks that. For
    files whose columns come in different orders hand in their ``groups``.
    """
    wanted = {f.name.lower(): f for f in kind.fields}
    if groups is None:
        groups = {tuple(spark.read.option("header", True).csv(path).columns): path}
    parts = []
    for header, files in groups.items():
        names = T.StructType([_typed(n, wanted) for n in header])
        read = spark.read.schema(names).option("header", True).option("enforceSchema", False)
        part = read.option("mode", "FAILFAST").csv(files)
        parts.append(part.select(*[c for c in part.columns if c.lower() in wanted], *extra))
    found = union_all(parts)
    have = {c.lower() for c in found.columns}
    return found.select(
        *[F.col(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields],
        *[c for c in found.columns if c.lower() not in wanted],
    )


def _typed(name: str, wanted: dict[str, T.StructField]) -> T.StructField:
    known = wanted.get(name.lower())
    return T.StructField(name, known.dataType if known else T.StringType())


def files_by_header(spark: SparkSession, folder: str | list[str]) -> Groups:
    """CSV files at or below the folder, grouped by their header line. The
    driver gets one short row per file, which it needs to name the files."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(folder)
    starts = text.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("_at"))
    starts = starts.where("_metadata.file_block_start = 0")
    # ids rise within a file's first block, which one task reads from its start
    first = starts.groupBy("path").agg(F.min_by("value", "_at").alias("header"))
    groups: Groups = defaultdict(list)
    for row in first.collect():
        groups[tuple(c.strip() for c in next(csv.reader([row.header])))].append(row.path)
    if not groups:
        raise FileNotFoundError(f"no .csv file under {folder}")
    return dict(groups)


def probe(spark: SparkSession, path: str) -> DataFrame:
    """Probe rows of one vehicle class."""
    return read_csv(spark, path, schema.PROBE)


def as_segments(raw: DataFrame) -> DataFrame:
    """Segment attributes under the joint names: ``tmc`` becomes ``tmc_code``
    and the direction text becomes the code ``DIR``."""
    renamed = raw.withColumnsRenamed({"tmc": "tmc_code", "direction": "DIR"})
    return renamed.withColumn("DIR", direction_code(F.col("DIR")))


def segments(spark: SparkSession, path: str) -> DataFrame:
    return as_segments(read_csv(spark, path, schema.SEGMENT))


def as_matches(raw: DataFrame) -> DataFrame:
    """Matches under the joint names. ``DIR`` is not kept: a match is made only
    where it equals the direction of the segment, which brings its own."""
    return raw.select(
        F.col("Tmc").alias("tmc_code"),
        "STATION_ID",
        F.col("County").alias("shape_county"),
        F.col("State").alias("shape_state"),
        F.col("LAT").alias("station_lat"),
        F.col("LONG").alias("station_long"),
        "tier",
    )


def matches(spark: SparkSession, path: str) -> DataFrame:
    return as_matches(read_csv(spark, path, schema.MATCH))


def stations(spark: SparkSession, path: str) -> DataFrame:
    """Stations; ids stay text, so leading zeros survive."""
    return read_csv(spark, path, schema.STATION)


def shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Every shape file below a folder, stacked by column name. The line may be
    in any of the known geometry columns; a file without one is an error."""
    groups = files_by_header(spark, folder)
    names = {geometry_column(list(header)) for header in groups}
    extra = [T.StructField(n, T.StringType()) for n in names - {"geometry"}]
    rows = read_csv(spark, folder, T.StructType(schema.SHAPE.fields + extra), groups)
    line = F.coalesce(*[F.col(n) for n in ["geometry", *(f.name for f in extra)]])
    return rows.withColumn("geometry", line).select(*schema.SHAPE.names)


#: Count columns that would clash with segment columns (names differ only in
#: case), and the names they get.
COUNT_RENAMES = {
    "STATE": "count_state_code",
    "STATE_NAME": "state",
    "COUNTY": "count_county_code",
    "COUNTY_NAME": "count_county",
    "F_SYSTEM": "station_f_system",
    "ROUTE_SIGN": "count_route_sign",
    "LAT": "count_lat",
    "LONG": "count_long",
}


def as_counts(raw: DataFrame) -> DataFrame:
    """Hourly counts with a time stamp and the joint names."""
    parts: list[Column] = [F.col(c) for c in ("YEAR", "MONTH", "DAY", "HOUR")]
    stamped = raw.withColumn("measurement_tstamp", count_timestamp(*parts))
    return stamped.withColumnsRenamed(COUNT_RENAMES).withColumn("DIR", F.col("DIR").cast("int"))


def raw_counts(spark: SparkSession, path: str) -> DataFrame:
    """The 33 declared columns of the hourly count file."""
    return read_csv(spark, path, schema.COUNT)


def counts(spark: SparkSession, path: str) -> DataFrame:
    return as_counts(raw_counts(spark, path))


def dataset(spark: SparkSession, path: str, rebuild=None, refresh: bool = False) -> DataFrame:
    """A joined dataset by file kind: ``.csv`` with text segment codes, else
    Parquet. ``rebuild`` (a function without arguments that returns the
    dataset) is called, and its result stored at ``path``, when the path does
    not exist or ``refresh`` is set; any other error is raised."""
    from segflow.sources.writers import write_table

    if refresh and rebuild is not None:
        write_table(rebuild(), path)
    try:
        return table(spark, path)
    except AnalysisException as error:
        if rebuild is None or error.getCondition() != "PATH_NOT_FOUND":
            raise
        write_table(rebuild(), path)
        return table(spark, path)


def table(spark: SparkSession, path: str) -> DataFrame:
    """Any stored table: CSV with inferred types but text ids, else Parquet. A
    path that does not exist is an error, not an empty result."""
    if path.rstrip("/").endswith(".csv"):
        read = spark.read.option("header", True)
        names = read.csv(path).columns
        typed = read.option("inferSchema", True).csv(path).schema
        text = {"tmc_code", "STATION_ID"}
        fields = [T.StructField(n, T.StringType() if n in text else typed[n].dataType) for n in names]
        return spark.read.schema(T.StructType(fields)).option("header", True).csv(path)
    return spark.read.parquet(path)


def dataset_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All station files of a dataset folder written by
    :func:`segflow.sources.writers.write_by_station`, or those in force of one written by
    :func:`segflow.sources.parts.write_stations`. Ids stay text."""
    from segflow.sources.parts import STATION_PART, has_parts, read_parts

    if has_parts(spark, folder):
        return read_parts(spark, folder, STATION_PART)
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        return spark.read.option("mergeSchema", True).parquet(folder)
    finally:
        spark.conf.set(key, before)


def stations_of_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Distinct stations that have files in any of the dataset folders."""
    return union_ids([dataset_folder(spark, f) for f in folders], "STATION_ID")


def station_of_file(name: Column, suffix: str = ".pkl") -> Column:
    """Station id in a ``station_state_year`` file name; null unless the name
    has the suffix and exactly three parts."""
    parts = F.split(name, "_")
    return F.when(name.endswith(suffix) & (F.size(parts) == 3), parts[0])


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions; the columns every report needs must be there."""
    needed = [schema.TARGET, schema.PREDICTION, *schema.PROBE_KEY]
    return schema.require_columns(table(spark, path), needed)

"""Tables whose parts are replaced as a whole, and the cached scan of CSV files.

A table lies in a folder as Parquet below ``run=<id>/<key>=<value>``, or, where a write has more
parts than :data:`FOLDERS`, below ``run=packed-<id>`` with its rows in order of their keys: files
then follow the bytes, not the parts. Every write is a new run;
a small record, written last and put in place by one rename, says which run each part
is read from. So a rerun replaces only the parts that it makes, files of other parts
are not touched, a reader sees all of a write or nothing of it, and a job that
stops halfway leaves only a run that no record names. Two writers at a time are told
apart: the later one gets an error. The rename must be atomic, as on HDFS and local disks.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segflow import schema
from segflow.sources.readers import files_by_header, read_csv

_RECORDS = "_commits"
#: Most parts of a write that get a folder of their own.
FOLDERS = 500
#: How the name of a run without such folders begins.
_PACKED = "packed-"


class WriteConflict(RuntimeError):
    """Another write of the same table came first."""


def _files(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the records, oldest first: a number and the run that wrote it."""
    fs, place = _files(spark, f"{folder}/{_RECORDS}")
    if not fs.exists(place):
        return []
    return sorted(n for s in fs.listStatus(place) if (n := s.getPath().getName())[:1].isdigit())


def has_parts(spark: SparkSession, folder: str) -> bool:
    """Whether the folder holds a table with records."""
    return bool(_names(spark, folder))


def parts(spark: SparkSession, folder: str) -> DataFrame | None:
    """The parts in force: their keys, what else was said of them, and their ``run``."""
    names = _names(spark, folder)
    return spark.read.parquet(f"{folder}/{_RECORDS}/{names[-1]}/parts") if names else None


def _same(keys: list[str]) -> list[Column]:
    return [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]


def replace_parts(df: DataFrame, folder: str, keys: list[str], replaced: DataFrame | None = None, gone: DataFrame | None = None) -> None:
    """Write ``df`` so that its rows take the place of all earlier ones with their ``keys``.

    ``replaced`` names the parts that this write stands for, if that are more than those with
    rows, and may say more of them in further columns; the parts in ``gone`` go.
    Columns may come and go between runs; a row lacks, as null, those its run did not have.
    """
    spark = df.sparkSession
    names = _names(spark, folder)
    run = _write(df, folder, keys, replaced)
    kinds = T.StructType([df.schema[k] for k in keys])
    if replaced is None:
        replaced = _written(spark, folder, [run], df.schema, keys).select(*keys).distinct()
    made = replaced.select(*[F.col(f.name).cast(f.dataType) for f in kinds], *[c for c in replaced.columns if c not in keys], F.lit(run).alias("run"))
    known, fields = parts(spark, folder), df.schema
    if known is not None:
        kept = known.alias("l").join(made.alias("r"), _same(keys), "left_anti")
        if gone is not None:
            kept = kept.alias("l").join(gone.alias("r"), _same(keys), "left_anti")
        made = kept.unionByName(made, allowMissingColumns=True)
        earlier = _schema(spark, folder, names[-1])
        fields = T.StructType([*df.schema.fields, *[f for f in earlier if f.name not in df.schema.names]])
    draft = f"{folder}/{_RECORDS}/.{run}"
    made.write.parquet(f"{draft}/parts")
    spark.createDataFrame([(fields.json(),)], "value string").coalesce(1).write.text(f"{draft}/schema")
    _put_in_force(spark, folder, names, run, draft)


def _write(df: DataFrame, folder: str, keys: list[str], replaced: DataFrame | None) -> str:
    """Write the rows of a run; its name. Where it is not known how many parts there are, the rows
    are written packed, and once more by folder if the parts are few."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    few = replaced is not None and replaced.limit(FOLDERS + 1).count() <= FOLDERS
    if not few:
        # an empty text is none, as in the name of a folder
        text = {k: F.when(F.col(k) != "", F.col(k)) for k in keys if df.schema[k].dataType == T.StringType()}
        path = f"{folder}/run={_PACKED}{run}"
        df.withColumns(text).sortWithinPartitions(*keys).write.parquet(path)
        rows = spark.read.schema(df.schema).parquet(path)
        if rows.select(*keys).distinct().limit(FOLDERS + 1).count() > FOLDERS:
            return _PACKED + run
        df = rows
    df.write.partitionBy(*keys).parquet(f"{folder}/run={run}")
    if not few:
        fs, place = _files(spark, path)
        fs.delete(place, True)
    return run


def _put_in_force(spark: SparkSession, folder: str, names: list[str], run: str, draft: str) -> None:
    number = f"{int(names[-1].split('-')[0]) + 1 if names else 1:012d}-"
    fs, place = _files(spark, draft)
    final = _files(spark, f"{folder}/{_RECORDS}/{number}{run}")[1]
    others = [n for n in _names(spark, folder) if n not in names]
    if not others and fs.rename(place, final):
        others = [n for n in _names(spark, folder) if n.startswith(number) and n < number + run]
        if not others:
            return
        fs.delete(final, True)
    raise WriteConflict(f"{folder}: {', '.join(others) or 'the record was not put in place'}")


def _schema(spark: SparkSession, folder: str, name: str) -> T.StructType:
    import json

    return T.StructType.fromJson(json.loads(spark.read.text(f"{folder}/{_RECORDS}/{name}/schema").first().value))


def _written(spark: SparkSession, folder: str, runs: list[str], fields: T.StructType, keys: list[str]) -> DataFrame:
    """The rows of the runs, their ``keys`` and ``run`` last."""
    kind = T.StructType([*fields.fields, T.StructField("run", T.StringType())])
    found = []
    for some in ([r for r in runs if not r.startswith(_PACKED)], [r for r in runs if r.startswith(_PACKED)]):
        if some:
            read = spark.read.schema(kind).option("basePath", folder).parquet(*[f"{folder}/run={r}" for r in some])
            found.append(read.select(*[c for c in fields.names if c not in keys], *keys, "run"))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], kind)


def read_parts(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """The rows of the parts in force. Only runs that a part is read from are listed; a filter on
    the keys prunes folders, and of packed runs row groups."""
    names = _names(spark, folder)
    if not names:
        raise FileNotFoundError(f"no record of parts in {folder}")
    live = parts(spark, folder)
    runs = sorted(r.run for r in live.select("run").distinct().collect())
    rows = _written(spark, folder, runs, _schema(spark, folder, names[-1]), keys)
    return rows.alias("l").join(live.select(*keys, "run").alias("r"), _same([*keys, "run"]), "left_semi").drop("run")


def drop_unused(spark: SparkSession, folder: str) -> int:
    """Delete runs that the record in force does not name, and all earlier records; how many
    runs went. Not while others read or write the table."""
    names = _names(spark, folder)
    live = {r.run for r in parts(spark, folder).select("run").distinct().collect()}
    fs, place = _files(spark, folder)
    stale = [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("run=") and s.getPath().getName()[4:] not in live]
    drafts = [s.getPath() for s in fs.listStatus(_files(spark, f"{folder}/{_RECORDS}")[1]) if s.getPath().getName() not in names[-1:]]
    for path in [*drafts, *stale]:
        fs.delete(path, True)
    return len(stale)


# ---- cached scan of CSV files -----------------------------------------------


def _fingerprint() -> Column:
    """Tells a file and its version: a new length or time is another file."""
    meta = F.col("_metadata")
    return F.hex(F.xxhash64(meta["file_path"], meta["file_size"], meta["file_modification_time"])).alias("file_id")


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """``file_id``, ``path``, ``length``, ``modified`` of the CSV files below a folder. No
    file is opened."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    found = read.load(folder)
    return found.select(_fingerprint(), F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))


def changed_files(spark: SparkSession, folder: str, cache: str) -> DataFrame:
    """The files that the cache does not hold in their present version."""
    known, files = parts(spark, cache), csv_files(spark, folder)
    return files if known is None else files.join(known.select("file_id"), "file_id", "left_anti")


def cached_scan(spark: SparkSession, folder: str, cache: str, kind: T.StructType = schema.COUNT) -> DataFrame:
    """All rows of the CSV files below ``folder``, typed by ``kind``, from the Parquet table
    ``cache``, which is brought up to date first.

    Files are told by path, length and time; only new or changed ones are parsed, each in
    place of its earlier version, and rows of vanished files go, all in one step.
    A value that does not fit its type is an error and changes nothing. A file that changes
    while it is parsed is parsed again by the next scan. Files with a header alone
    count as parsed.
    """
    from segflow.session import stored

    new = stored(changed_files(spark, folder, cache), "changed")
    known = parts(spark, cache)
    gone = None if known is None else stored(known.select("file_id").join(csv_files(spark, folder).select("file_id"), "file_id", "left_anti"), "gone")
    paths = [r.path for r in new.select("path").collect()]
    if paths or (gone is not None and not gone.isEmpty()):
        rows = spark.createDataFrame([], T.StructType([*kind.fields, T.StructField("file_id", T.StringType())]))
        if paths:
            rows = read_csv(spark, paths, kind, files_by_header(spark, paths), _fingerprint())
        replace_parts(rows, cache, ["file_id"], new, gone)
    return read_parts(spark, cache, ["file_id"]).select(*kind.names)


# ---- stations and the importance log ----------------------------------------

STATION_PART = ["year", "STATION_ID", "state"]


def write_stations(df: DataFrame, folder: str, year: str) -> None:
    """The rows of each station, state and year in place of earlier ones; all other stations
    stay as they are. A station's rows are gathered, and split where they are too many
    for one task; more stations than :data:`FOLDERS` share files."""
    balanced = df.withColumn("year", F.lit(year)).hint("rebalance", "STATION_ID", "state")
    replace_parts(balanced, folder, STATION_PART)


def write_importance(log: DataFrame, folder: str) -> None:
    """The rows of each test epoch in place of earlier ones, so that a run which goes on after a
    stop neither repeats nor loses an epoch."""
    replace_parts(log, folder, ["epoch"])


def read_importance(spark: SparkSession, folder: str) -> DataFrame:
    """``epoch``, ``feature`` and what is logged of them."""
    return read_parts(spark, folder, ["epoch"])

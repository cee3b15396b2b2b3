"""Writers for datasets, predictions, id lists, logs and run settings."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segflow.operators.rank import key_hash, with_row_number


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, or CSV with a header for a path that ends in ``.csv``."""
    if path.rstrip("/").endswith(".csv"):
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """A table bucketed and sorted by ``keys``. Tables bucketed alike join on
    these keys without a shuffle: worth it for probe tables joined every time."""
    gathered = df.repartition(buckets, *keys)  # one file per bucket
    writer = gathered.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def write_by_station(df: DataFrame, folder: str, year: str) -> None:
    """One folder per station and state below ``year=<year>``. The rebalance
    hint gathers the rows of a station, merges small shuffle partitions and
    splits the ones of a station too large for one task."""
    balanced = df.hint("rebalance", "STATION_ID", "state")
    balanced.write.mode("overwrite").partitionBy("STATION_ID", "state").parquet(f"{folder}/year={year}")


def write_ids(matches: DataFrame, path: str, column: str = "Tmc") -> None:
    """One id per line, no header."""
    matches.where(F.col(column).isNotNull()).select(column).write.mode("overwrite").text(path)


def joined_ids(matches: DataFrame, column: str, keys: list[str], per_line: int = 1_000) -> DataFrame:
    """The ids as comma-joined text for pasting into a download form, at most
    ``per_line`` ids a line: ``(line, ids)``."""
    hashed = matches.select(column, key_hash(*keys).alias("_hash"))
    numbered = with_row_number(hashed, "_hash").withColumn("line", F.floor(F.col("row_no") / per_line))
    return numbered.groupBy("line").agg(F.concat_ws(",", F.sort_array(F.collect_list(column))).alias("ids"))


def write_predictions(df: DataFrame, folder: str, dataset: str) -> None:
    """``<dataset>_predictions`` as Parquet and as CSV."""
    write_table(df, f"{folder}/{dataset}_predictions.parquet")
    write_table(df, f"{folder}/{dataset}_predictions.csv")


def write_run(spark: SparkSession, settings: dict, path: str) -> None:
    """Run settings as one JSON row; values JSON cannot hold go in as text."""
    text = json.dumps(settings, default=str)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def append_importance(log: DataFrame, path: str) -> None:
    """Add the rows of one test epoch to the importance log."""
    log.write.mode("append").parquet(path)


def write_report(metrics: DataFrame, path: str) -> None:
    """Display rows ``(Metric, Value)`` as CSV."""
    write_table(metrics, path if path.endswith(".csv") else f"{path}.csv")


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; whether there was one."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def list_models(spark: SparkSession, folder: str, suffix: str = ".model") -> list[str]:
    """Model folders below ``folder`` whose name ends in ``suffix``."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(folder)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    wanted = suffix if suffix.startswith(".") else f".{suffix}"
    found, queue = [], [base]
    while queue:
        for status in fs.listStatus(queue.pop()):
            child = status.getPath()
            if child.getName().endswith(wanted):
                found.append(child.toString())
            elif status.isDirectory():
                queue.append(child)
    return sorted(found)

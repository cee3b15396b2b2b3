"""Small table operators: unions, reshaping, coercion and repairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_ids(frames: list[DataFrame], column: str) -> DataFrame:
    """Distinct ids that occur in any of the frames."""
    ids = [f.select(column).where(F.col(column).isNotNull()).distinct() for f in frames]
    return union_all(ids).distinct()


def lost_ids(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Distinct ids of ``before`` that ``after`` no longer has. Both sides are
    reduced to their ids before the shuffle, so a hot id weighs no more than others."""
    return before.select(column).distinct().join(after.select(column).distinct(), column, "left_anti")


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose text is empty or one space; nulls stay."""
    return df.where(~F.coalesce(F.col(column).isin("", " "), F.lit(False)))


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null or NaN in the columns. One condition per column:
    the built-in ``dropna`` makes a single condition over all of them, of which
    the optimiser keeps a copy for every later combination of renamed columns."""
    kinds = dict(df.dtypes)
    for c in columns or df.columns:
        df = df.where(F.col(c).isNotNull())
        if kinds[c] in ("double", "float"):
            df = df.where(~F.isnan(c))
    return df


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text to double; text that is no number becomes null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns or df.columns})


def repair_codes(df: DataFrame, pattern: str, wrong: str, right: str, direction: int) -> DataFrame:
    """Rows whose segment code matches ``pattern``, with ``wrong`` replaced by
    ``right`` in the code and the direction overwritten."""
    hits = df.where(F.col("tmc_code").rlike(pattern))
    return hits.withColumns(
        {"tmc_code": F.regexp_replace("tmc_code", wrong, right), "DIR": F.lit(direction)}
    )


def to_long(df: DataFrame, ids: list[str], name: str, value: str) -> DataFrame:
    """Wide to long: every column but ``ids`` becomes a ``(name, value)`` row."""
    columns = [c for c in df.columns if c not in ids]
    doubles = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(ids, columns, name, value)


def metric_rows(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """One-row metrics to display rows ``(Metric, Value)``, all values as text."""
    rows = F.array(*[F.struct(F.lit(k).alias("Metric"), v.cast("string").alias("Value")) for k, v in texts.items()])
    return df.select(F.explode(rows).alias("r")).select("r.Metric", "r.Value")

"""Segment codes, directions and categories as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.schema import DIRECTIONS

#: Largest category index the driver turns into a literal.
MAP_LIMIT = 1_000


def segment_variant(code: Column) -> Column:
    """Variant of a segment code: P, N, -, + give 0, 1, 2, 3 and none gives -1.
    The letters are looked for in this order, so P wins over a later sign."""
    text = F.lower(code)
    variant = F.when(text.contains("p"), 0)
    for number, letter in enumerate("n-+", start=1):
        variant = variant.when(text.contains(letter), number)
    return variant.otherwise(-1)


def segment_number(code: Column) -> Column:
    """Segment code without its variant letter, as a number. Any other letter
    is an error (ANSI cast), not a null."""
    return F.regexp_replace(F.lower(code), "[pn+-]", "").cast("bigint")


def direction_code(text: Column, names: dict[str, int] = DIRECTIONS) -> Column:
    """Direction text to its odd-number code; unknown or missing text is null."""
    code = F.lit(None).cast("int")
    for name, number in names.items():
        code = F.when(text == name, number).otherwise(code)
    return code


def category_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """Table ``(column_name, value, code)``: codes 0, 1, … per column in
    alphabetical order. Write it next to a model and hand it back to
    :func:`encode_categories`, so training and prediction share the codes."""
    values = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])
        ).alias("v")
    ).select("v.column_name", "v.value")
    distinct = values.where(F.col("value").isNotNull()).distinct()
    order = Window.partitionBy("column_name").orderBy("value")
    return distinct.withColumn("code", (F.row_number().over(order) - 1).cast("int"))


def encode_categories(df: DataFrame, columns: list[str], index: DataFrame) -> DataFrame:
    """Replace each column by its code. Missing values and values the index
    does not know share one code after the last, so no row is lost. An index of
    at most ``MAP_LIMIT`` entries becomes a map literal; a larger one is joined."""
    entries = index.limit(MAP_LIMIT + 1).collect()
    if len(entries) > MAP_LIMIT:
        return _encode_by_join(df, columns, index)
    codes = {}
    for column in columns:
        pairs = [(e.value, e.code) for e in entries if e.column_name == column]
        known = F.create_map(*[F.lit(x) for pair in pairs for x in pair])[F.col(column)] if pairs else F.lit(None)
        codes[column] = F.coalesce(known.cast("int"), F.lit(len(pairs)))
    return df.withColumns(codes)


def _encode_by_join(df: DataFrame, columns: list[str], index: DataFrame) -> DataFrame:
    order = df.columns
    for column in columns:
        known = index.where(F.col("column_name") == column)
        size = known.agg(F.count("*").cast("int")).scalar()
        known = known.select(F.col("value").alias(column), F.col("code").alias("_code"))
        df = df.join(known, column, "left").withColumn(column, F.coalesce("_code", size)).drop("_code")
    return df.select(*order)

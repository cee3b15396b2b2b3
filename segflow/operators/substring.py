"""Lookup of the first place whose name contains a text, for a column of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Pieces of ``size`` characters, one from each place; none of a shorter text."""
    last = F.length(text) - size + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, size))).otherwise(F.array().cast("array<string>"))


def first_containing(rows: DataFrame, text: str, places: DataFrame, name: str, prefix: str) -> DataFrame:
    """All ``rows``, each with the columns of the first place, by name, whose name contains
    its ``text`` in any case; their names get the ``prefix``.

    An index lists the pieces of up to three characters of all names. A text is looked up
    once, however many rows have it, by its rarest piece; only names with that
    are compared. A null text has no place, an empty one is in every name; of places with one name
    the first by its other columns counts. Rows are neither lost nor multiplied.
    """
    others = [c for c in places.columns if c != name]
    held = places.where(F.col(name).isNotNull()).select(F.struct(name, *others).alias("_place"), F.lower(name).alias("_name"))
    wanted = rows.select(F.lower(text).alias("_text")).where(F.col("_text").isNotNull()).distinct()
    pieces = F.array_distinct(F.flatten(F.array(*[_grams(F.col("_name"), n) for n in range(1, _GRAM + 1)])))
    index = held.select("_place", "_name", F.explode(pieces).alias("_gram"))
    number = index.groupBy("_gram").agg(F.count("*").alias("_n"))
    own = F.when(F.length("_text") < _GRAM, F.array("_text")).otherwise(F.array_distinct(_grams(F.col("_text"), _GRAM)))
    asked = wanted.where("_text <> ''").select("_text", F.explode(own).alias("_gram")).join(number, "_gram", "left")
    rarest = asked.groupBy("_text").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_key"))
    rarest = rarest.where("_key.n > 0").select("_text", F.col("_key._gram").alias("_gram"))
    hits = rarest.join(index, "_gram").where(F.contains("_name", "_text"))
    first = hits.groupBy("_text").agg(F.min("_place").alias("_found"))
    every = held.agg(F.min("_place").alias("_found")).where("_found is not null").select(F.lit("").alias("_text"), "_found")
    found = first.unionByName(every)
    joined = rows.withColumn("_text", F.lower(text)).join(found, "_text", "left").drop("_text")
    return joined.select(*rows.columns, *[F.col("_found")[c].alias(f"{prefix}{c}") for c in (name, *others)])

"""Histograms over pre-counted values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equal_width_histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """``bins`` equal bins between the smallest and largest value, the last one
    closed: ``(bin, lower, upper, n)``, empty bins included. If all values are
    equal the range is widened by a half to both sides."""
    counted = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v"))
    counted = counted.agg(F.count("*").alias("n"))
    low, high = F.min("v"), F.max("v")
    edge = F.when(low == high, F.lit(0.5)).otherwise(F.lit(0.0))
    ends = counted.agg((low - edge).alias("lo"), (high + edge).alias("hi"))
    span = ends.select(F.struct("lo", "hi")).scalar()
    lo, hi = span.getField("lo"), span.getField("hi")
    number = F.least(F.floor((F.col("v") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    filled = counted.groupBy(number.cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    frame = ends.where("lo is not null").select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(filled, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def fixed_width_histogram(df: DataFrame, value: str, width: float, upper: float) -> DataFrame:
    """Bins of ``width`` from 0 to ``upper``, the last one closed; values
    outside, nulls and NaN are left out: ``(lower, n)``, empty bins included."""
    last = round(upper / width) - 1
    inside = df.where(F.col(value).between(0, upper) & ~F.isnan(value))
    number = F.least(F.floor(F.col(value) / width), F.lit(last))
    counts = inside.groupBy((number * width).cast("double").alias("lower")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(last + 1).select((F.col("id") * width).cast("double").alias("lower"))
    return frame.join(counts, "lower", "left").select("lower", F.coalesce("n", F.lit(0)).alias("n"))

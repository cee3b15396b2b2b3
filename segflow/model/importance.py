"""Permutation importance over a distributed test table."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.model.data import INPUTS, SCORE
from segflow.model.regress import VolumeModel
from segflow.operators.rank import with_row_number
from segflow.schema import TARGET
from segflow.session import stored


def shuffles(features: list[str], n: int, repeats: int, seed: int) -> list[tuple[int, int, int]]:
    """``(feature, factor, start)`` of permutations of the numbers below ``n``: row i takes
    the value of row (factor * i + start) modulo n. The factor has no divisor in common
    with n, so no row is taken twice."""
    out = []
    for k, name in enumerate(features):
        for repeat in range(repeats):
            digest = hashlib.md5(f"{seed}|{name}|{repeat}".encode()).hexdigest()
            factor = 1 + int(digest[:8], 16) % n
            while math.gcd(factor, n) > 1:
                factor += 1
            out.append((k, factor, int(digest[8:16], 16) % n))
    return out


def permutation_importance(model: VolumeModel, test: DataFrame, target: str = TARGET, repeats: int = 3, seed: int = 42) -> DataFrame:
    """``(feature, importance, deviation)``: mean growth of the mean squared error when the
    values of one feature are dealt to other rows, and its deviation over ``repeats``.

    Rows are numbered in hash order; every feature and repeat has its own permutation of the
    numbers. A row sends each value to the row that takes it: one join on the row
    number moves all of them, and the variants are scored and summed where they arrive. The
    join is a merge at any size: of an array of inputs Spark estimates one number, so it would
    broadcast rows far beyond its threshold. ``test`` needs its ``row_hash``.
    """
    features = model.scaler.features
    n = max(1, test.count())
    rows = model.scaler.inputs(test).select("row_hash", F.col(target).alias("_y"), INPUTS)
    # numbered once and stored: both sides of the join read it
    numbered = stored(with_row_number(rows, "row_hash"), "numbered").select("row_no", "_y", INPUTS)
    # products of row numbers pass a long beyond two thousand million rows
    wide = "bigint" if n < 1 << 31 else "decimal(38, 0)"
    ways = [(i, k, pow(factor, -1, n), start) for i, (k, factor, start) in enumerate(shuffles(features, n, repeats, seed))]
    way = F.array(*[F.struct(*[F.lit(x).cast("bigint").alias(c) for x, c in zip((i, k, back, start), ("i", "k", "back", "start"))]) for i, k, back, start in ways])
    sent = numbered.select("row_no", INPUTS, F.explode(way).alias("_way"))
    to = F.pmod((F.col("row_no").cast(wide) - F.col("_way.start")) * F.col("_way.back"), F.lit(n).cast(wide)).cast("bigint")
    value = F.element_at(INPUTS, (F.col("_way.k") + 1).cast("int"))
    moved = sent.select(to.alias("row_no"), F.col("_way.i").alias("_i"), F.col("_way.k").alias("_k"), value.alias("_value"))
    variants = moved.join(numbered.hint("merge"), "row_no")
    mixed = F.transform(INPUTS, lambda v, i: F.when(i == F.col("_k"), F.col("_value")).otherwise(v))
    error = F.col("_y") - F.col(SCORE)
    mse = F.avg(error * error).alias("_mse")
    per_way = model.score_inputs(variants.select("_i", "_k", "_y", mixed.alias(INPUTS))).groupBy("_i", "_k").agg(mse)
    base = model.score_inputs(numbered).agg(mse).scalar()
    names = F.array(*[F.lit(f) for f in features])
    growth = per_way.select(F.element_at(names, (F.col("_k") + 1).cast("int")).alias("feature"), (F.col("_mse") - base).alias("_growth"))
    return growth.groupBy("feature").agg(F.avg("_growth").alias("importance"), F.stddev_pop("_growth").alias("deviation"))


def log_row(importance: DataFrame, epoch: int) -> DataFrame:
    """Importance of one epoch as rows of the long log."""
    return importance.select(F.lit(epoch).alias("epoch"), "feature", "importance")


def wide_log(log: DataFrame, features: list[str]) -> DataFrame:
    """The long log with one column per feature."""
    return log.groupBy("epoch").pivot("feature", features).agg(F.first("importance"))

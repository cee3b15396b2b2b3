"""Global order without a single-task sort: row numbers, exact percentiles,
first rows per key and repeatable samples.

Row numbers and percentiles share one idea. A coarse bucket that respects the
wanted order is computed per row, the buckets are counted (a small table with
a fixed upper bound of rows), running totals over that table give each bucket
its offset, and the fine order is only established inside a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hex digits of the hash that name a bucket: at most 16**4 = 65,536 buckets.
PREFIX_DIGITS = 4
#: Percentile buckets per doubling of the value. A double has 2,046 binary
#: exponents, so there are never more than about a million buckets.
PER_OCTAVE = 256
#: Distinct values of a percentile bucket beyond which it is cut further.
CROWD = 50_000
#: Ranges to which an octave of the distance from an end of a crowded bucket is cut.
END_STEPS = 16


def key_hash(*columns: str) -> Column:
    """md5 over the text of the key columns: the repeatable pseudo-random order
    behind splits, samples and row numbers, whatever the partitioning."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]))


def expand_copies(df: DataFrame, copies: str, number: str, block: int = 1_000_000) -> DataFrame:
    """One row per copy, numbered from 0 in ``number``. Rows with more than
    ``block`` copies are dealt out in blocks, so no task makes them all."""
    few = df.where(F.col(copies) <= block).withColumn(number, F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / block)))
    many = df.where(F.col(copies) > block).withColumn("_block", blocks)
    many = many.repartition("_block", F.xxhash64(*df.columns))
    last = F.least((F.col("_block") + 1) * block, F.col(copies)) - 1
    many = many.withColumn(number, F.explode(F.sequence(F.col("_block") * block, last))).drop("_block")
    return few.unionByName(many)


def with_row_number(df: DataFrame, hash_column: str, name: str = "row_no") -> DataFrame:
    """Number rows 0, 1, … in the order of a hash column.

    Copies of a row are counted before the shuffle and numbered as one range;
    the hash prefix spreads the distinct rows evenly, so a bucket to sort holds
    about 1/65,536 of them, however skewed the keys were. The offsets meet the rows in a
    merge join, for which the rows already lie in place, whatever Spark takes their size to be.
    """
    distinct = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    prefixed = distinct.withColumn("_prefix", F.substring(hash_column, 1, PREFIX_DIGITS))
    totals = prefixed.groupBy("_prefix").agg(F.sum("_copies").alias("_total"))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_prefix", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_prefix").orderBy(hash_column).rowsBetween(Window.unboundedPreceding, -1)
    placed = prefixed.withColumn("_inside", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    first = placed.join(offsets.hint("merge"), "_prefix").withColumn("_first", F.col("_offset") + F.col("_inside"))
    each = expand_copies(first, "_copies", "_nth")
    return each.select(*df.columns, (F.col("_first") + F.col("_nth")).alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each key under an explicit order. Spark cuts each key down
    to one row in every map task before the shuffle, so a hot key stays cheap."""
    numbered = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.where("_rn = 1").drop("_rn")


def sample_by_hash(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """``n`` rows in pseudo-random order of ``keys`` (all rows if fewer); the
    same rows for the same seed on every cluster."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(order, *keys).limit(n)


def in_test_share(*keys: str, share: float = 0.10) -> Column:
    """True for the test rows of a repeatable split: the first eight hex digits
    of the key hash, taken modulo 1000, fall below the share."""
    number = F.conv(F.substring(key_hash(*keys), 1, 8), 16, 10).cast("bigint")
    return number % 1000 < round(share * 1000)


def _value_bucket(value: Column) -> Column:
    size = F.floor(F.log2(F.abs(value) + 1) * PER_OCTAVE)
    return F.when(value < 0, -size - 1).otherwise(size)


def _refined(counted: DataFrame, by: list[str]) -> DataFrame:
    """Add ``_s``, a second bucket below ``_b``: buckets with more than ``CROWD`` distinct
    values, which a narrow range of large or of tiny values makes, are cut into equal
    ranges, about one for each ``CROWD`` values, and each range by the distance from the nearer
    end of the bucket on a logarithmic scale, as an outlier leaves all other values
    at one end. All others have the one range 0."""
    crowds = counted.groupBy(*by, "_b").agg(F.count("*").alias("_k"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, "_b"]]
    joined = counted.alias("l").join(crowds.where(F.col("_k") > CROWD).alias("r"), same, "left")
    ranges = F.ceil(F.col("_k") / CROWD)
    width = F.col("_most") - F.col("_least")
    share = (F.col("_v") - F.col("_least")) / width
    part = F.least(F.floor(share * ranges), ranges - 1)
    # 64 octaves from either end; a value on an end has no logarithm
    near = lambda distance: F.floor((F.greatest(F.coalesce(F.log2(distance / width), F.lit(-64.0)), F.lit(-64.0)) + 64) * END_STEPS)
    inner = F.when(share <= 0.5, near(F.col("_v") - F.col("_least"))).otherwise(128 * END_STEPS - near(F.col("_most") - F.col("_v")))
    fine = F.coalesce(part * (129 * END_STEPS) + inner, F.lit(0)).cast("long")
    return joined.select(*[F.col(f"l.{c}") for c in counted.columns], fine.alias("_s"))


def exact_percentiles(df: DataFrame, value: str, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact, linearly interpolated percentiles as ``(*by, prob, value)``.

    Equal values are counted before any shuffle; only the one or two buckets
    that hold the wanted ranks are ordered. No task sees a whole group, unlike
    the built-in ``percentile``, which keeps every distinct value of a group.
    """
    by = by or []
    counted = (
        df.select(*by, F.col(value).cast("double").alias("_v"))
        .where("_v is not null and not isnan(_v)")
        .groupBy(*by, "_v")
        .agg(F.count("*").alias("_c"))
        .withColumn("_b", _value_bucket(F.col("_v")))
    )
    counted = _refined(counted, by)
    totals = counted.groupBy(*by, "_b", "_s").agg(F.sum("_c").alias("_in_bucket"))
    # running totals: over the fine buckets of a coarse one, then over coarse buckets
    coarse = totals.groupBy(*by, "_b").agg(F.sum("_in_bucket").alias("_in_coarse"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    coarse = coarse.withColumns(
        {"_before": F.coalesce(F.sum("_in_coarse").over(earlier), F.lit(0)), "_n": F.sum("_in_coarse").over(group)}
    )
    upto = Window.partitionBy(*by, "_b").orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*by, "_b"]]
    fine = totals.withColumn("_upto", F.sum("_in_bucket").over(upto))
    placed = fine.alias("l").join(coarse.alias("r"), same).select(
        *[F.col(f"l.{c}") for c in by], "l._b", "_s", "_in_bucket", (F.col("_before") + F.col("_upto")).alias("_end"), "_n"
    )
    wanted = (
        placed.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_pos", F.col("prob") * (F.col("_n") - 1))
        .withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos"), "_start": F.col("_end") - F.col("_in_bucket")})
        .where("_start <= _hi and _end > _lo")
        .select(*by, "_b", "_s", "prob", "_pos", "_lo", "_hi", "_start")
    )
    inside = Window.partitionBy(*by, "prob", "_b", "_s").orderBy("_v").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    ranked = (
        counted.join(wanted, [*by, "_b", "_s"])
        .withColumn("_to", F.col("_start") + F.sum("_c").over(inside))
        .withColumn("_from", F.col("_to") - F.col("_c"))
    )

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_from") <= F.col(rank)) & (F.col(rank) < F.col("_to")), F.col("_v")))

    ends = ranked.groupBy(*by, "prob").agg(
        at("_lo").alias("_below"), at("_hi").alias("_above"), F.max(F.col("_pos") - F.col("_lo")).alias("_part")
    )
    return ends.select(*by, "prob", (F.col("_below") + (F.col("_above") - F.col("_below")) * F.col("_part")).alias("value"))


def percentile_cuts(df: DataFrame, value: str, probs: list[float]) -> list[Column]:
    """The percentiles of a whole table as scalar columns, from one subquery."""
    found = exact_percentiles(df, value, probs)
    pairs = F.collect_list(F.struct("prob", "value"))  # one entry per wanted percentile
    cuts = found.agg(F.map_from_entries(pairs)).scalar()
    return [F.element_at(cuts, F.lit(float(p))) for p in probs]

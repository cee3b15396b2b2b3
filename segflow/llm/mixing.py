"""Mixing sources to target weights by blocks of words.

Each source's words, in a fixed pseudo-random order of its rows, are packed into
blocks of equal length. A source's target gives its number of slots. Output shards have
an equal number of slots, and every slot draws its source with the sources' shares, so a
shard's counts are one multinomial draw. Free draws would miss a target by the square
root of its blocks: what a source draws beyond its slots, in the last shards, goes to
those that drew too few. The k-th slot of a source takes block permutation(k), a new
permutation for each pass over the source, and blocks are joined to slots by their
number. The last slot takes the part of a block that is still missing. All work but the
table of sources (one row each) is spread by slot, block or bucket, not by source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segflow.llm.common import WORD, boxed, bucket_of, bucket_starts, group_key, running_start, unboxed
from segflow.session import stored

#: Words of a block, most slots of an output shard, shards that are counted together, and rounds
#: of the permutation.
BLOCK, SHARD_SLOTS, SHARDS, ROUNDS = 512, 4096, 1024, 12


def words_of(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


# ---- targets ----------------------------------------------------------------


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``_group``, ``source_size``, ``target`` for each source of ``sizes`` (``source``,
    ``size``).

    Sources in code-point order, null last, have the weights in turn. All words are
    shared by weight; a share above ``most`` times its source's size is cut to that and
    the rest shared again, until none is above. Sources ordered by how soon they reach
    their bound make this one pass: the sources that are cut come first.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    named = total.withColumn("_weight", weight).withColumn("_most", (most * F.col("source_size")).cast("double"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("_most") / F.col("_weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(earlier), F.lit(0.0))
    open_weight = F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = named.withColumn("_level", left / open_weight).withColumn("_cut", F.col("_most") <= F.col("_level") * F.col("_weight"))
    # levels rise up to that of the first source that is not cut, then fall
    final = F.max("_level").over(everything)
    share = F.when(F.col("_cut"), F.col("_most")).otherwise(F.least("_most", final * F.col("_weight")))
    return level.select(group_key(F.col("source")).alias("_group"), "source_size", share.alias("target"), F.sum("source_size").over(everything).alias("_all"))


# ---- slots ------------------------------------------------------------------


def permuted(index: Column, size: Column, key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudo-random permutation of 0 to ``size`` - 1, different for each ``key``.

    In each round every number has a partner (their sum is a keyed constant modulo
    ``size``); a keyed bit of the larger one decides whether the two change places.
    """

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("partner"), key, r), size) - x, size)
        swap = F.xxhash64(F.lit("swap"), key, r, F.greatest(x, partner)) % 2 != 0
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index, step)


def drawn(spark: SparkSession, sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """``_group``, ``_k``, ``shard``, ``order`` of ``total`` slots: the source that each draws, in
    proportion to ``_slots``, and the slot's number among those of the source."""
    upto = Window.partitionBy(F.lit(0)).orderBy("_group").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one entry for each source
    ends = sources.select(F.struct(F.sum("_slots").over(upto).alias("end"), "_group").alias("_end")).agg(F.array_sort(F.collect_list("_end"))).scalar()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = max(total, 1)
    # all shards have as many slots, give or take one
    slot = spark.range(0, total, 1, tasks).select("id", F.expr(f"id * {-(-some // shard_slots)} div {some}").alias("shard"), ends.alias("_ends"))
    at = F.pmod(F.xxhash64(F.lit("draw"), F.lit(seed), "id"), F.lit(some))
    chosen = slot.select("id", "shard", F.get(F.filter("_ends", lambda e: e["end"] > at), F.lit(0))["_group"].alias("_group"))
    # a source's slots in earlier shards: of earlier runs of shards, then of the run
    counts = chosen.groupBy("_group", "shard").agg(F.count("*").alias("_n")).withColumn("_run", F.expr(f"shard div {SHARDS}"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    runs = counts.groupBy("_group", "_run").agg(F.sum("_n").alias("_n")).withColumn("_earlier", before(Window.partitionBy("_group").orderBy("_run")))
    within = counts.withColumn("_inner", before(Window.partitionBy("_group", "_run").orderBy("shard"))).join(runs.drop("_n"), ["_group", "_run"])
    number = F.row_number().over(Window.partitionBy("_group", "shard").orderBy("id")) - 1
    placed = chosen.withColumn("_own", number).join(within.select("_group", "shard", (F.col("_inner") + F.col("_earlier")).alias("_start")), ["_group", "shard"])
    return placed.select("_group", (F.col("_start") + F.col("_own")).alias("_k"), "shard", F.xxhash64(F.lit("order"), F.lit(seed), "id").alias("order"))


def slots(plan: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 42) -> DataFrame:
    """``_group``, ``epoch``, ``block``, ``take``, ``shard``, ``order``: one row for each
    block that the mix takes; ``take`` is less than a block only in a source's last.

    ``plan`` is the result of :func:`targets`. Within a shard, rows come by ``order``.
    """
    size, full = F.col("source_size"), F.expr(f"source_size div {block}")
    words = F.round("target").cast("long")
    made = plan.where(size > 0).withColumns({"_full": full, "_blocks": F.ceil(size / block).cast("long"), "_words": words})
    made = made.withColumns({"_passes": F.expr("_words div source_size"), "_rest": F.expr("_words % source_size")})
    made = made.withColumn("_slots", F.col("_passes") * F.col("_blocks") + F.ceil(F.col("_rest") / block).cast("long")).where("_slots > 0")
    made = stored(made.select("_group", "_full", "_blocks", "_passes", "_rest", "_slots"), "sources")
    total = made.agg(F.coalesce(F.sum("_slots"), F.lit(0))).first()[0]
    each = stored(drawn(plan.sparkSession, made, total, shard_slots, seed).join(made, "_group"), "drawn")
    # what sources drew too much, about the square root of all slots, for what others lack
    over = each.where("_k >= _slots").select("shard", "order", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("order", "_k")) - 1).alias("_nth"))
    had = each.groupBy("_group").agg(F.count("*").alias("_had"))
    short = made.join(had, "_group", "left").withColumn("_had", F.coalesce("_had", F.lit(0).cast("long"))).where("_had < _slots")
    lack = short.select(*made.columns, F.explode(F.sequence("_had", F.col("_slots") - 1)).alias("_k"))
    lack = lack.withColumn("_nth", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_group", "_k")) - 1)
    each = each.where("_k < _slots").unionByName(lack.join(over, "_nth").drop("_nth"))
    each = each.withColumns({"epoch": F.expr("_k div _blocks"), "_i": F.expr("_k % _blocks")})
    key = F.xxhash64(F.lit(seed), "_group", "epoch")
    # the short block at a source's end keeps its place; all others are permuted
    number = F.when(F.col("_i") < F.col("_full"), permuted(F.col("_i"), F.greatest("_full", F.lit(1).cast("long")), key)).otherwise(F.col("_i"))
    take = F.when(F.col("epoch") < F.col("_passes"), F.lit(block).cast("long")).otherwise(F.least(F.lit(block).cast("long"), F.col("_rest") - F.col("_i") * block))
    return each.select("_group", "epoch", number.alias("block"), take.alias("take"), "shard", "order")


# ---- the mix ----------------------------------------------------------------


def sized(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What the mix needs of each row, without the text."""
    text_column = F.col(text)
    return docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"), words_of(text_column).alias("size"), F.xxhash64(text_column).alias("_hash"))


def mix(rows: DataFrame, weights: Sequence[float] = (5, 2, 1), most: int = 3, block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 42) -> DataFrame:
    """The pieces of rows that the mix takes: ``doc_id``, ``source``, ``size``, ``_hash``,
    ``copy`` (equal rows are numbered), ``source_size``, ``target`` and for each piece
    ``first`` and ``until`` (words of the row), ``epoch``, ``shard``, ``order``.

    ``rows`` is the result of :func:`sized`. A block that is not taken leaves a row
    without a piece, so every input row appears. Sources take their target, rounded to a word, so no row is
    taken more than ``most`` times. The draw depends on rows and seed only, not on
    partitions. Null and empty texts have no words; a null source is a source, the
    last; an empty table gives no row. Equal rows are counted before the shuffle.
    """
    plan = stored(targets(rows, weights, most), "targets")
    copies = rows.groupBy("doc_id", "source", "size", "_hash").agg(F.count("*").alias("_copies"))
    copies = copies.withColumns({"_group": group_key(F.col("source")), "_bucket": bucket_of(F.lit(seed), "doc_id", "_hash"), "_order": F.xxhash64("_hash", F.lit(seed), "doc_id")})
    length = F.col("size") * F.col("_copies")
    starts = bucket_starts(copies, "_group", length).join(plan.drop("_all"), "_group")
    laid = running_start(copies, "_group", length, [F.col("_order"), F.col("doc_id"), F.col("_hash"), F.col("size")], starts)
    each = laid.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    each = each.withColumn("_from", F.col("_before") + F.col("copy") * F.col("size")).withColumn("_to", F.col("_from") + F.col("size"))
    spans = F.when(F.col("size") > 0, F.sequence(F.expr(f"_from div {block}"), F.expr(f"(_to - 1) div {block}")))
    columns = ["doc_id", "source", "size", "_hash", "copy", "source_size", "target", "_group", "_from", "_to"]
    pieces = each.select(*columns, F.explode_outer(spans).alias("block"))
    # slots grow with the data, which the size estimate of exploded rows does not see
    taken = pieces.join(slots(plan, block, shard_slots, seed).hint("merge"), ["_group", "block"], "left")
    begin = F.col("block") * block
    first = F.greatest(F.col("_from"), begin) - F.col("_from")
    # least() passes over null: a block without a slot must not look taken
    until = F.when(F.col("take").isNotNull(), F.least(F.col("_to"), begin + F.col("take")) - F.col("_from"))
    out = taken.select(*columns[:7], first.alias("first"), until.alias("until"), "epoch", "shard", "order")
    none = ~F.coalesce(F.col("first") < F.col("until"), F.lit(False))
    return out.withColumns({c: F.when(~none, F.col(c)) for c in ("first", "until", "epoch", "shard", "order")})


def taken_words(pieces: DataFrame) -> DataFrame:
    """One row per input row: how many of its words the mix takes, repeats counted, and
    ``pieces``, the (``shard``, ``order``, ``words``) that it is taken in."""
    row = ["doc_id", "source", "size", "_hash", "copy", "source_size", "target"]
    words = F.col("until") - F.col("first")
    piece = F.when(words > 0, F.struct("shard", "order", words.alias("words")))
    return pieces.groupBy(*row).agg(F.coalesce(F.sum(words), F.lit(0).cast("long")).alias("taken"), F.array_sort(F.collect_list(piece)).alias("pieces"))


def mixed_texts(docs: DataFrame, **settings) -> DataFrame:
    """The documents as the mix takes them, all columns kept: one row for each pass of
    the mix over a document, with the words that the pass takes, in their order and
    with the white space between them. ``n_chars``, where there is one, is counted
    anew. Documents of which nothing is taken go, and so do those without a word.
    """
    pieces = mix(stored(sized(docs), "sizes"), **settings).where("first is not null")
    passes = pieces.groupBy("doc_id", "_hash", group_key(F.col("source")).alias("_group"), "copy", "epoch", "size").agg(
        F.sort_array(F.collect_list(F.struct("first", "until"))).alias("_spans"), F.min(F.struct("first", "shard", "order")).alias("_place")
    )
    passes = passes.select(F.xxhash64("doc_id", "_hash", "_group").alias("_key"), "_hash", "copy", "_spans", "size", "_place")
    group = group_key(F.col("source").cast("string"))
    own = docs.select(boxed(docs).alias("_doc"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_own_hash"), group.alias("_own_group"))
    own = own.withColumn("_own_key", F.xxhash64("_id", "_own_hash", "_own_group")).repartition("_own_key")
    number = Window.partitionBy("_own_key", "_id", "_own_hash", "_own_group").orderBy(F.xxhash64("_doc"))
    own = own.withColumn("_own_copy", (F.row_number().over(number) - 1).cast("long"))
    # one key for numbering and join, so that texts are shuffled once; the rest is compared bit by bit
    other = F.col("_own_hash").bitwiseXOR(F.col("_hash")).bitwiseOR(F.col("_own_copy").bitwiseXOR(F.col("copy")))
    joined = own.join(passes, (F.col("_own_key") == F.col("_key")) & (other == 0)).select("_doc", "_spans", "size", "_place")
    before = F.col("_doc")["text"]
    tokens = F.regexp_extract_all(before, F.lit(WORD + r"[\x20\x09-\x0D]*+"), F.lit(0))
    first, last = F.array_min(F.transform("_spans", lambda s: s["first"])), F.array_max(F.transform("_spans", lambda s: s["until"]))
    length = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["until"] - s["first"])
    cut = joined.withColumns({"_whole": (length == F.col("size")) & (first == 0) & (last == F.col("size"))}).withColumn("_tokens", F.when(~F.col("_whole"), tokens))
    piece = F.transform("_spans", lambda s: F.array_join(F.slice(F.col("_tokens"), (s["first"] + 1).cast("int"), (s["until"] - s["first"]).cast("int")), ""))
    text = F.when(F.col("_whole"), before).otherwise(F.array_join(piece, ""))
    taken = cut.select("_doc", text.alias("_text"), F.col("_place.shard").alias("_shard"), F.col("_place.order").alias("_order"))
    taken = taken.repartition("_shard").sortWithinPartitions("_shard", "_order")
    filled = F.col("_doc").withField("text", F.col("_text"))
    if "n_chars" in docs.columns:
        filled = filled.withField("n_chars", F.length("_text").cast(docs.schema["n_chars"].dataType))
    return unboxed(taken.withColumn("_doc", filled), docs.columns)

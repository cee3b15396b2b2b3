"""Chat formatting in windows of a token budget, in column expressions only.

A conversation's turns have prefix sums of their tokens. The sums cut it into spans of
whole turns: a turn belongs to the stride in which it begins, and one that crosses the
stride's end is a span of its own. A window repeats the system turn, then as many turns
before the span as fit a history budget, then has the span's turns. Only assistant turns
of the span are under the loss mask, so each is a target once. Prefix sums are taken by
blocks of turn numbers, and windows are bounded, so a long conversation is many rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.session import stored

#: Turn numbers of a block of prefix sums.
TURNS = 1024
#: Fixed values of the template. Texts and roles cannot hold a mark: in them "<" is
#: written as "\<" and "\" as "\\".
OPEN, MIDDLE, CLOSE = "<turn:", ">", "</turn>\n"
#: A turn as it is written: role and text, of which only escapes hold "\" or "<".
TURN = r"<turn:((?:[^\\<>]|\\[\s\S])*+)>((?:[^\\<]|\\[\s\S])*+)</turn>\n"


@dataclass(frozen=True)
class Budget:
    """Tokens of a window's new turns and of the history before them. A window has at most
    both, the system turn, and what a single longer turn, which is never cut, has in excess."""

    stride: int = 384
    history: int = 128


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def tokens(text: Column) -> Column:
    """What a turn costs: four code points of its text are a token, and its marks four, so turns
    without a word and words of any length count as well."""
    return (F.ceil(F.length(text) / 4) + 4).cast("long")


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template."""
    return F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE), escaped(text), F.lit(CLOSE))


def turns(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """``conv``, ``seq`` (from 0), ``role``, ``text``, ``size`` and ``begin``, the tokens before the
    turn in its conversation.

    The order is by turn, then role and text; null role and text count as empty, and a
    null turn comes first. Sums go by blocks of turn numbers, then over blocks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    read = conversations.select(F.col(key).alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), tokens(text).alias("size"))
    read = read.withColumn("_block", F.coalesce(F.floor(F.col("turn") / TURNS).cast("long"), F.lit(-(1 << 62)).cast("long")))
    sums = read.groupBy("conv", "_block").agg(F.count("*").alias("_n"), F.sum("size").alias("_size"))
    earlier = Window.partitionBy("conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0).cast("long")
    starts = sums.select("conv", "_block", F.coalesce(F.sum("_n").over(earlier), nothing).alias("_rows"), F.coalesce(F.sum("_size").over(earlier), nothing).alias("_tokens"))
    same = read["conv"].eqNullSafe(starts["conv"]) & (read["_block"] == starts["_block"])
    joined = read.join(starts, same).select(read["*"], "_rows", "_tokens")
    inner = Window.partitionBy("conv", "_block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.coalesce(F.sum("size").over(inner.rowsBetween(Window.unboundedPreceding, -1)), nothing)
    return joined.select("conv", (F.col("_rows") + F.row_number().over(inner) - 1).alias("seq"), "role", "text", "size", (F.col("_tokens") + before).alias("begin"))


def windows(laid: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row for each window: ``conv``, ``first`` (number of its first new turn),
    ``context`` (repeated turns at its start), ``formatted``, and ``mask``, the
    (start, end) code points that count in the loss.

    ``laid`` is the result of :func:`turns`. A turn is sent to the spans it can be history
    of, which lie within the history budget, and the system turn to all spans of its
    conversation; spans gather their turns by one shuffle.
    """
    end = F.col("begin") + F.col("size")
    bin_of = F.expr(f"begin div {budget.stride}")
    crosses = (end > (bin_of + 1) * budget.stride).cast("int")
    own = laid.withColumns({"_bin": bin_of, "_part": crosses})
    spans = own.groupBy("conv", "_bin", "_part").agg(F.min("seq").alias("_first"), F.min("begin").alias("_from"))
    new = own.select("conv", "_bin", "_part", F.lit(1).alias("_new"), "seq", "role", "text")
    # history: spans that begin after the turn and at most the budget after its begin
    last = F.expr(f"(begin + {budget.history}) div {budget.stride}")
    after = F.explode(F.sequence(F.col("_bin"), last)).alias("_to")
    is_system = (F.col("seq") == 0) & (F.col("role") == "system")
    past = laid.withColumn("_bin", bin_of).where((F.col("size") <= budget.history) & ~is_system).select("*", after).select("conv", F.col("_to").alias("_bin"), "seq", "role", "text", F.col("begin").alias("_begin"))
    system = laid.where(is_system).select("conv", "seq", "role", "text")
    named = spans.select(F.col("conv").alias("_conv"), F.col("_bin").alias("_span_bin"), "_part", "_first", "_from")
    close = past["conv"].eqNullSafe(named["_conv"]) & (past["_bin"] == named["_span_bin"])
    near = close & (past["seq"] < named["_first"]) & (past["_begin"] >= named["_from"] - budget.history)
    columns = ["conv", "_bin", "_part", F.lit(0).alias("_new"), "seq", "role", "text"]
    history = past.join(named, near).select(*columns)
    kept = system["conv"].eqNullSafe(named["_conv"]) & (system["seq"] < named["_first"])
    first = system.join(named, kept).select("conv", F.col("_span_bin").alias("_bin"), *columns[2:])
    everything = new.unionByName(history).unionByName(first)
    piece = F.struct("seq", "_new", "role", "text")
    gathered = everything.groupBy("conv", "_bin", "_part").agg(F.array_sort(F.collect_list(piece)).alias("_turns"))
    return gathered.select("conv", *_formatted(F.col("_turns")))


def _formatted(some: Column) -> list[Column]:
    texts = F.transform(some, lambda t: rendered(t["role"], t["text"]))
    context = F.size(F.filter(some, lambda t: t["_new"] == 0))
    first = F.array_min(F.transform(F.filter(some, lambda t: t["_new"] == 1), lambda t: t["seq"]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(F.lit(OPEN)) + F.length(escaped(t["role"])) + F.length(F.lit(MIDDLE))
        stop = begin + F.length(escaped(t["text"]))
        span = F.array(F.struct(begin.alias("start"), stop.alias("end")))
        target = (t["_new"] == 1) & (t["role"] == "assistant")
        return F.struct((stop + F.length(F.lit(CLOSE))).alias("at"), F.when(target, F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    mask = F.aggregate(some, start, step, lambda a: a["spans"])
    return [first.alias("first"), context.alias("context"), F.array_join(texts, "").alias("formatted"), mask.alias("mask")]


def read_back(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation say: ``turns`` (role, text) in order, each
    once, ``targets``, the text under the mask, and ``formatted_chars``.

    A conversation comes together in one row here, as its reader wants it.
    """
    each = F.regexp_extract_all("formatted", F.lit(TURN), F.lit(0))
    parsed = F.transform(
        F.slice(each, F.col("context") + 1, F.greatest(F.size(each) - F.col("context"), F.lit(0))),
        lambda t: F.struct(unescaped(F.regexp_extract(t, TURN, 1)).alias("role"), unescaped(F.regexp_extract(t, TURN, 2)).alias("text")),
    )
    masked = F.transform("mask", lambda m: unescaped(F.substring(F.col("formatted"), m["start"] + 1, m["end"] - m["start"])))
    one = formatted.select("conv", "first", parsed.alias("turns"), F.array_join(masked, "").alias("targets"), F.length("formatted").cast("long").alias("chars"))
    whole = one.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("first", "turns", "targets"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv", F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"), F.array_join(F.transform("w", lambda x: x["targets"]), "").alias("targets"), "formatted_chars")


def format_conversations(conversations: DataFrame, budget: Budget = Budget(), key: str = "conv_id") -> DataFrame:
    """:func:`windows` of a table of turns (``conv_id``, ``turn``, ``role``, ``text``).

    Columns beyond these four are not read. Texts of any length are one turn each. Repeated rows are repeated turns; a null
    conversation is one conversation; an empty table has no window.
    """
    # stored once: spans, history and system turns are all made from it
    return windows(stored(turns(conversations, key), "turns"), budget)

"""Line dedup by a tree of line templates.

A line's path in the tree is its number of words, then its leading words to a fixed
depth, where a word with a digit counts as a variable field. In a leaf there are two kinds
of templates. Lines that are equal but for such fields are one. For the other, what follows
the leading words is cut into sixteen parts (in shorter lines fewer, of one word each): a part
that recurs at its place in the leaf is fixed, the others are fields, and lines with the
same fixed parts share a template, if their fields are short. A template that recurs in enough
documents is dropped from all but one of them. Long lines go from the second document
on where they are equal.

Texts are parsed twice, without a shuffle: first the leaves are counted, then only lines of
leaves that recur are written out, which tasks tell by a bit table of bounded size. What
it lets through besides is never dropped, as all counts are of whole hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import WORD, bit_table, boxed, bound_batches, unboxed
from segflow.session import ship, stored

#: A word with a digit, found in linear time.
_FIELD = re.compile(rb"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+")
_DIGIT = re.compile(rb"[0-9]")
_PARTS = 16


@dataclass(frozen=True)
class Settings:
    """``depth``: leading words in the path. ``words``: shorter lines are dropped only if
    they hold a letter outside of fields. ``documents``: how many have to share a
    template; equal lines of more than ``long_words`` go from the second document on.
    ``fields``: words that fields may have, and at most one in ``fields_of`` of the line's."""

    depth: int = 4
    words: int = 3
    documents: int = 3
    long_words: int = 50
    fields: int = 8
    fields_of: int = 4


def row_key(key: Column, text: Column) -> Column:
    """Rows with the same key and text are one document."""
    return F.xxhash64(F.lit("row"), key, text)


# ---- lines and their parts --------------------------------------------------


def words_of(line: bytes) -> list[bytes]:
    """The words of a line, those with a digit as one variable field."""
    return (_FIELD.sub(b"<*>", line) if _DIGIT.search(line) else line).split()


def parts_of(rest: int) -> list[int]:
    """Where the parts of so many words begin, and the end."""
    parts = min(rest, _PARTS)
    return [rest * p // parts for p in range(parts + 1)] if parts else [0]


def _lines(settings: Settings, text: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Place and words of the lines that may go."""
    for place, line in enumerate(text.split(b"\n")):
        words = words_of(line)
        if len(words) >= settings.words or (words and any(c.isalpha() for w in words for c in w.decode("utf-8", "replace"))):
            yield place, words


def _leaf(settings: Settings, words: list[bytes]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b"%d %s" % (len(words), b" ".join(words[: settings.depth])))


def _leaves(settings: Settings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf and number of words of every line."""
    for batch in batches:
        rows, leaves, counts = [], [], []
        for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text").cast(pa.binary()).to_pylist()):
            for _, words in _lines(settings, text):
                rows.append(row)
                leaves.append(_leaf(settings, words))
                counts.append(len(words))
        columns = [pa.array(rows, pa.int64()), pa.array(np.array(leaves, np.uint64).view(np.int64)), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["_row", "_leaf", "_n"])


def _near(settings: Settings, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line of a leaf in the table, with the hashes of the line and of its parts."""
    import xxhash

    of = xxhash.xxh3_64_intdigest
    for batch in batches:
        found, leaves = [], []
        for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text").cast(pa.binary()).to_pylist()):
            for place, words in _lines(settings, text):
                found.append((row, place, words))
                leaves.append(_leaf(settings, words))
        leaves = np.array(leaves, np.uint64)
        kept = np.flatnonzero(shared.value.holds(leaves))
        found = [found[i] for i in kept.tolist()]
        parts, offsets = [], [0]
        for _, _, words in found:
            rest = words[settings.depth :]
            ends = parts_of(len(rest))
            parts.extend(of(b" ".join(rest[a:b]), p + 1) for p, (a, b) in enumerate(zip(ends, ends[1:])))
            offsets.append(len(parts))
        hashes = lambda values: pa.array(np.array(values, np.uint64).view(np.int64))
        columns = [
            pa.array([r for r, _, _ in found], pa.int64()),
            pa.array([p for _, p, _ in found], pa.int32()),
            pa.array([len(w) for _, _, w in found], pa.int64()),
            hashes(leaves[kept]),
            hashes([of(b" ".join(w)) for _, _, w in found]),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), hashes(parts)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["_row", "_pos", "_n", "_leaf", "_line", "_parts"])


# ---- templates --------------------------------------------------------------


def _enough(settings: Settings) -> Column:
    """In how many documents a line of ``_n`` words has to be."""
    return F.when(F.col("_n") > settings.long_words, min(2, settings.documents)).otherwise(settings.documents)


def templates(docs: DataFrame, settings: Settings, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_row``, ``_positions``: the lines that go, by document."""
    spark = docs.sparkSession
    ship(spark)
    bound_batches(spark)
    read = docs.select(row_key(F.col(key), F.col(text)).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    leaves = read.mapInArrow(partial(_leaves, settings), "_row long, _leaf long, _n long")
    counted = leaves.groupBy("_leaf", "_n").agg(F.count("*").alias("n"), F.min("_row").alias("a"), F.max("_row").alias("b"))
    hot = stored(counted.where((F.col("n") >= _enough(settings)) & (F.col("a") != F.col("b"))).select("_leaf"), "leaves")
    shared = spark.sparkContext.broadcast(bit_table(hot, F.col("_leaf")))
    near = read.mapInArrow(partial(_near, settings, shared), "_row long, _pos int, _n long, _leaf long, _line long, _parts array<long>")
    # one row for each document and line; copies inside a document go together
    seen = near.groupBy("_leaf", "_line", "_row", "_n").agg(F.collect_set("_pos").alias("_pos"), F.first("_parts").alias("_parts"))
    seen = stored(seen, "lines")
    lines = seen.groupBy("_leaf", "_line", "_n").agg(F.count("*").alias("_documents"), F.min("_row").alias("_first"), F.first("_parts").alias("_parts"))
    lines = stored(lines, "different")
    recurring = lines.where(F.col("_documents") >= _enough(settings)).select("_leaf", "_line", "_first")
    judged = seen.drop("_parts", "_n").join(recurring, ["_leaf", "_line"], "left")
    judged = stored(judged, "judged")
    gone = judged.where("_row != _first").select("_row", "_pos")
    # of a line that recurs as it is only the row that stays takes part
    left = judged.where("_first is null or _row = _first").select("_leaf", "_line", "_row", "_pos")
    dropped = gone.unionByName(_generalised(left, lines, settings))
    return dropped.groupBy("_row").agg(F.array_distinct(F.flatten(F.collect_list("_pos"))).alias("_positions"))


def _generalised(left: DataFrame, lines: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``left`` whose template, with fields, another document keeps.

    A part is fixed where ``documents`` pairs of a document and a line have it.
    """
    several = lines.groupBy("_leaf").agg(F.count("*").alias("n")).where("n > 1").select("_leaf")
    able = lines.where(F.col("_n") > settings.depth + 1).join(several, "_leaf", "left_semi")
    each = stored(able.select("_leaf", "_line", "_n", "_documents", F.posexplode("_parts").alias("_at", "_part")), "parts")
    fixed = each.groupBy("_leaf", "_at", "_part").agg(F.sum("_documents").alias("n")).where(F.col("n") >= settings.documents)
    held = each.join(fixed.drop("n"), ["_leaf", "_at", "_part"])
    rest = F.col("_n") - settings.depth
    parts = F.least(rest, F.lit(_PARTS))
    size = F.floor(rest * (F.col("_at") + 1) / parts) - F.floor(rest * F.col("_at") / parts)
    # the fixed parts, by place, are the template
    shape = F.xxhash64("_leaf", F.sort_array(F.collect_list(F.struct("_at", "_part")))).alias("_template")
    formed = held.groupBy("_leaf", "_line", "_n").agg(F.sum(size).alias("_same"), shape)
    fields = F.col("_n") - settings.depth - F.col("_same")
    formed = formed.where((fields > 0) & (fields <= settings.fields) & (fields * settings.fields_of <= F.col("_n")))
    members = stored(left.join(formed.select("_leaf", "_line", "_template"), ["_leaf", "_line"]).select("_template", "_row", "_pos"), "members")
    shared = members.groupBy("_template").agg(F.count_distinct("_row").alias("n"), F.min("_row").alias("_keeper"))
    shared = shared.where(F.col("n") >= settings.documents).drop("n")
    return members.join(shared, "_template").where("_row != _keeper").select("_row", "_pos")


def cut_lines(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_doc`` (the row of ``docs``, its text without the lines that go), ``n_lines``,
    ``n_dropped`` and ``own_share``, the share of the text's words that stay (1 without
    words). The text is shuffled once, and only here."""
    gone = templates(docs, settings, key, text)
    own = docs.select(boxed(docs).alias("_doc"), row_key(F.col(key), F.col(text)).alias("_row"))
    joined = own.join(gone, "_row", "left")
    before = F.col("_doc").getField(text)
    lines = F.split(before, "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    rest = F.array_join(F.transform(F.array_except(numbers, F.col("_positions")), lambda i: F.get(lines, i)), "\n")
    dropped = F.coalesce(F.size("_positions"), F.lit(0))
    cut = joined.select(
        "_doc",
        F.coalesce(F.when(before.isNotNull(), F.size(lines)), F.lit(0)).alias("n_lines"),
        dropped.alias("n_dropped"),
        F.when(dropped > 0, rest).alias("_rest"),
    )
    words = lambda column: F.regexp_count(column, F.lit(WORD))
    share = F.when(F.col("_rest").isNull() | (words(before) == 0), 1.0).otherwise(words(F.col("_rest")) / words(before))
    changed = F.when(F.col("_rest").isNotNull(), F.col("_doc").withField(text, F.col("_rest"))).otherwise(F.col("_doc"))
    return cut.select(changed.alias("_doc"), "n_lines", "n_dropped", share.alias("own_share"))


def drop_lines(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the lines of recurring templates, in ``text``; ``n_lines`` and
    ``n_dropped`` are added and all other columns kept.

    Of the documents that share a template, the one whose hash is smallest keeps it.
    Documents without such a line are unchanged to the byte; a null text stays null and
    has no line. Lines are cut at line feeds; empty lines and those of
    one or two words without a letter stay, and so do all lines that share no more than their
    number of words and their leading words. Texts and lines of any length are read whole.
    Rows with equal key and text are one document and have equal results; an empty table gives
    one. Columns named ``n_lines`` or ``n_dropped`` are replaced.
    """
    return unboxed(cut_lines(docs, settings, key, text), docs.columns, ["n_lines", "n_dropped"])

"""SimHash near-duplicates: fingerprints, links by segment bit counts, components.

Two fingerprints that differ in d bits have, over any division into segments,
vectors of bit counts whose Manhattan distance is d at most. So a range join of
the small integer vectors under that distance finds every link; a comparison of
the fingerprints themselves decides. The range join runs on the unit grid: each
fingerprint is put into its own cell and the cells around it, such that two
within the distance meet in a cell, and the join is one on equal cells.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segflow.llm.common import boxed, unboxed, with_python
from segflow.session import stored

#: Bits of a fingerprint, of a segment of it, and of a count in a cell's number.
BITS, SEGMENT, COUNT = 64, 4, 3
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20


# ---- fingerprints -----------------------------------------------------------


def _shingles(words: list[bytes], width: int) -> list[bytes]:
    return [b" ".join(x) for x in zip(*[words[i:] for i in range(width)])]


def _pieces(data: bytes) -> list[bytes]:
    """The text cut at white space into pieces of about :data:`PIECE` bytes."""
    out, at = [], 0
    while len(data) - at > PIECE:
        cut = at + PIECE
        while cut < len(data) and data[cut] not in b" \t\n\r\x0b\x0c":
            cut += 1
        out.append(data[at:cut])
        at = cut
    return [*out, data[at:]]


def simhash(text: str | None, width: int = 3) -> int:
    """The fingerprint of one text, as an unsigned number.

    A-Z become lower-case, words are runs without ASCII white space, shingles
    have ``width`` words (a shorter text is one shingle), copies count. No word:
    zero. Memory is bounded by :data:`PIECE`, not by the text, as long as no
    single word is longer.
    """
    import xxhash

    hashed = partial(xxhash.xxh64_intdigest, seed=42)
    ones, total, rest = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces((text or "").encode().lower()):
        words = rest + piece.split()
        found = _shingles(words, width)
        rest = words[-(width - 1) :] if width > 1 else []
        if found:
            codes = np.fromiter(map(hashed, found), dtype="<u8", count=len(found))
            ones += np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(found)
    if not total:
        return hashed(b" ".join(rest)) if rest else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _signed(code: int) -> int:
    return code - (1 << BITS) if code >> (BITS - 1) else code


def _fingerprinter(width: int) -> Callable:
    return lambda texts: [[_signed(simhash(t, width)) for t in texts]]


def with_fingerprint(docs: DataFrame, width: int = 3, text: str = "text", drop: Sequence[str] = ()) -> DataFrame:
    """Add ``_code``, the fingerprint as a signed long, and keep all columns but ``drop``."""
    return with_python(docs, [text], [T.StructField("_code", T.LongType())], partial(_fingerprinter, width), drop)


def as_hex(code: Column) -> Column:
    return F.lower(F.lpad(F.hex(code), BITS // 4, "0"))


# ---- links ------------------------------------------------------------------


def _steps(radius: int) -> list[int]:
    """What to add to a cell's number to reach the cells at most ``radius`` unit
    steps away; each segment's count has a place of its own in the number."""
    segments = BITS // SEGMENT
    units = [sign << (COUNT * s) for s in range(segments) for sign in (0, 1)]
    units = sorted({u for u in units} | {-u for u in units})
    return sorted({sum(x) for x in product(units, repeat=radius)}) if radius else [0]


def _cell(code: Column, distance: int) -> Column:
    """The vector of segment bit counts in one number. Counts are moved up, so that
    no step below zero borrows from the next place."""
    counts = [
        F.shiftleft(F.bit_count(F.shiftrightunsigned(code, SEGMENT * s).bitwiseAND((1 << SEGMENT) - 1)).cast("long") + 1, COUNT * s)
        for s in range(BITS // SEGMENT)
    ]
    total = counts[0]
    for c in counts[1:]:
        total = total + c
    return total


def links(codes: DataFrame, distance: int = 2) -> DataFrame:
    """``a`` < ``b``: all pairs of different fingerprints that differ in at most
    ``distance`` (0 to 2) bits. ``codes`` has distinct values in ``_code``.

    One side steps half the distance, the other the rest. No hub can appear: at
    distance 2 a fingerprint has at most 2,080 partners, whatever the data.
    """
    if not 0 <= distance <= 2:
        raise ValueError("the cells leave room for a distance of up to 2")
    cell = _cell(F.col("_code"), distance)

    def cells(radius: int, name: str) -> DataFrame:
        near = F.explode(F.transform(F.array(*[F.lit(s).cast("long") for s in _steps(radius)]), lambda s: cell + s))
        return codes.select(F.col("_code").alias(name), near.alias("_cell"))

    if not distance:
        return codes.select(F.col("_code").alias("a"), F.col("_code").alias("b")).where(F.lit(False))
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # the size estimate of exploded rows does not see that each fingerprint is in up to 33 cells
    met = cells(distance - distance // 2, "a").hint("merge").join(cells(distance // 2, "b"), "_cell").where((F.col("a") != F.col("b")) & (differ <= distance))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(pairs: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(``node``, ``root``) for every node of ``pairs``: the smallest node reachable.

    Each round links all larger neighbours of a node to its smallest one, then all
    smaller ones, until nothing changes, which takes few rounds even on long chains. Rounds are written to the shared folder, so
    a lost executor costs one round. Neighbourhoods are aggregated, not collected.
    """
    edges = stored(pairs.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u != v").distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        star = down.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        after = stored(star.select("e.u", "e.v").where("u != v").distinct(), "edges")
        same = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(after, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v"), F.col("v")).distinct())


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, key: str = "doc_id") -> DataFrame:
    """One row per input row: the key, ``fingerprint`` and ``component_id``, the
    smallest key reachable over links of at most ``distance`` differing bits.

    Rows with equal fingerprints are one class, which stands for them in the join,
    so a large group of copies costs one row there. A null key is never the id of
    a component with other keys; a class whose keys are all null has a null id.
    A null or empty text, or one without a word, has fingerprint zero. An empty
    table gives no row. Columns other than key and text are not read.
    """
    judged = _grouped(docs, width, distance, key)
    return judged.select("doc_id", as_hex(F.col("_code")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, width: int, distance: int, key: str) -> DataFrame:
    """``doc_id``, ``_own`` (hash of the text), ``_code``, ``root`` and ``component_id`` of every row."""
    read = docs.select(F.col(key).alias("doc_id"), F.col("text"), F.xxhash64("text").alias("_own"))
    coded = stored(with_fingerprint(read, width, drop=["text"]), "codes")
    classes = stored(coded.groupBy("_code").agg(F.min("doc_id").alias("first")), "classes")
    found = stored(links(classes.select("_code"), distance), "links")
    roots = components(found)
    rooted = classes.join(roots, classes["_code"] == roots["node"], "left").select("_code", "first", F.coalesce("root", "_code").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("_code", "root", "component_id")
    return coded.join(named, "_code")


def keep_one(docs: DataFrame, width: int = 3, distance: int = 2, key: str = "doc_id") -> DataFrame:
    """Of each component the row with the smallest key, of several with that key the one whose
    text has the smallest hash; all columns kept. Different texts under one key are
    told apart, equal rows are one. Rows without a key cannot be told apart: they are passed on."""
    judged = _grouped(docs, width, distance, key).where("doc_id is not null")
    firsts = judged.groupBy("root").agg(F.min(F.struct("doc_id", "_own")).alias("_first"))
    firsts = stored(firsts.select(F.col("_first.doc_id").alias("_id"), F.col("_first._own").alias("_own")), "firsts")
    named = docs.select(boxed(docs).alias("_doc"), F.col(key).alias("_id"), F.xxhash64("text").alias("_own"))
    kept = named.join(firsts, ["_id", "_own"], "left_semi").dropDuplicates(["_id", "_own"])
    return unboxed(kept, docs.columns).unionByName(docs.where(F.col(key).isNull()))

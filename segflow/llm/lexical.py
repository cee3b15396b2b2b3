"""Ranked lexical search, part term-at-a-time and part document-at-a-time.

Every document's terms are counted once and stored. Queries come in blocks of a bounded
number of terms, which are broadcast. A task turns the documents it reads into shards with
posting lists of the block's terms. In a shard the short lists of a query are summed into
accumulators, term by term; these become one more iterator, whose bound is the largest sum.
It and the long lists are then run document by document: those whose bounds together
stay under the worst of the best so far cannot bring a document in, they are only looked
up, by skipping, for documents the others bring and that may still get among the
best. A task keeps the best of each query and carries their bar from shard to shard.

Documents go in windows, so all steps are on arrays. No list is cut: scores are exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.common import bound_batches
from segflow.session import ship, stored

#: Letters of a term are digits, A to Z as small letters, and all beyond ASCII.
_LETTERS = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_PLAIN = bytes(x if x in _LETTERS else 32 for x in bytes(range(256)).lower())


@dataclass(frozen=True)
class Settings:
    """``block_terms``: terms of the queries in a block, on average, which is what is
    broadcast. ``postings``: after so many a shard is closed. ``short``: a list is short with
    at most this share of the shard's documents. ``window``: documents handled at a time."""

    block_terms: int = 200_000
    postings: int = 2_000_000
    short: float = 1 / 16
    window: int = 4096


# ---- terms ------------------------------------------------------------------


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of terms, different terms with a space between them and how often each comes,
    for each text that has one."""
    for batch in batches:
        keep, sizes, names, counts = [], [], [], []
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            found = terms_of(text) if text else ()
            if found:
                each = Counter(found)
                keep.append(i)
                sizes.append(len(found))
                names.append(b" ".join(each))
                counts.append(np.fromiter(each.values(), np.int32, len(each)).tobytes())
        columns = [batch.column("key").take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(counts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "terms", "counts"])


def _term_table(texts: DataFrame, key: str, text: str) -> DataFrame:
    read = texts.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return read.mapInArrow(_counted, "key long, n long, terms string, counts binary")


def _numbered(batch: pa.RecordBatch, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number in the vocabulary and count of each of its terms in the documents."""
    lists = pc.split_pattern(batch.column("terms"), " ")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    number = pc.index_in(lists.flatten(), value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)
    known = np.flatnonzero(number >= 0)
    counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int32)
    return np.repeat(np.arange(len(lengths)), lengths)[known], number[known], counts[known].astype(np.int64)


# ---- queries ----------------------------------------------------------------


@dataclass
class _Block:
    """Queries as numbers of terms, and the vocabulary these belong to."""

    items: list
    terms: list[np.ndarray]
    vocabulary: pa.Array
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    documents: int = 0
    length: int = 0


def _block(rows: list) -> _Block:
    vocabulary = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(vocabulary)}
    return _Block([r["key"] for r in rows], [np.array(sorted(number[t] for t in r["terms"]), np.int64) for r in rows], pa.array(vocabulary, pa.string()))


def _frequencies(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of the batches each term of the vocabulary is."""
    vocabulary = shared.value.vocabulary
    found = np.zeros(len(vocabulary), np.int64)
    for batch in batches:
        if batch.num_rows:
            found += np.bincount(_numbered(batch, vocabulary)[1], minlength=len(vocabulary))
    some = np.flatnonzero(found)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], names=["term", "df"])


def weight(documents: int, df: int) -> int:
    """How much a term counts that ``df`` of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


# ---- shards -----------------------------------------------------------------


class _Best:
    """The best documents of a query, and the score another one needs."""

    def __init__(self, k: int):
        self.k, self.bar = k, 1
        self.scores, self.missing, self.keys = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, missing: np.ndarray, keys: np.ndarray) -> None:
        scores, missing, keys = (np.concatenate(x) for x in ((self.scores, scores), (self.missing, missing), (self.keys, keys)))
        order = np.lexsort((keys, missing, -scores))[: self.k]
        self.scores, self.missing, self.keys = scores[order], missing[order], keys[order]
        if len(order) == self.k:
            # an equal score may still win by its key
            self.bar = max(1, int(self.scores[-1]))


class _Shard:
    """Documents with posting lists: ``docs`` in rising order and what each adds to a score."""

    def __init__(self, block: _Block, settings: Settings):
        self.block, self.settings = block, settings
        self.parts: list[tuple] = []
        self.size = self.postings = 0

    def add(self, batch: pa.RecordBatch) -> None:
        row, term, count = _numbered(batch, self.block.vocabulary)
        key = batch.column("key")
        self.parts.append((row + self.size, term, count, batch.column("n").to_numpy(), pc.is_null(key).to_numpy(zero_copy_only=False), key.fill_null(0).to_numpy()))
        self.size += batch.num_rows
        self.postings += len(row)

    def close(self) -> None:
        row, term, count, n, self.missing, self.keys = (np.concatenate(x) for x in zip(*self.parts))
        self.parts = []
        length = share(n, self.block.documents, self.block.length)
        order = np.argsort(term, kind="stable")
        self.docs = row[order].astype(np.int32)
        term, count = term[order], count[order]
        self.adds = self.block.weights[term] * ((1_000_000_000 * count) // (1000 * count + 20 * length[self.docs]))
        self.start = np.searchsorted(term, np.arange(len(self.block.vocabulary) + 1))

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        spans = [slice(self.start[t], self.start[t + 1]) for t in terms[self.block.weights[terms] > 0].tolist()]
        return [(self.docs[s], self.adds[s]) for s in spans if s.stop > s.start]

    def search(self, terms: np.ndarray, best: _Best) -> None:
        lists = self.lists(terms)
        limit = self.settings.short * self.size
        runs = [x for x in lists if len(x[0]) > limit]
        short = [x for x in lists if len(x[0]) <= limit]
        if short:
            sums = np.zeros(self.size, np.int64)
            for docs, adds in short:
                sums[docs] += adds
            docs = np.flatnonzero(sums)
            if len(docs):
                runs.append((docs, sums[docs]))
        if not runs:
            return
        # by rising bound: the first ones, together under the bar, are only looked up
        bounds = np.array([int(adds.max()) for _, adds in runs])
        order = np.argsort(bounds, kind="stable")
        runs, bounds = [runs[i] for i in order], bounds[order]
        below = np.cumsum(bounds)
        at = np.zeros(len(runs), np.int64)
        for begin in range(0, self.size, self.settings.window):
            end = begin + self.settings.window
            lead = int(np.searchsorted(below, best.bar))
            if lead == len(runs):
                return
            partial_sums = np.zeros(min(end, self.size) - begin, np.int64)
            for i in range(lead, len(runs)):
                docs, adds = runs[i]
                first, last = at[i] + np.searchsorted(docs[at[i] :], [begin, end])
                at[i] = last
                partial_sums[docs[first:last] - begin] += adds[first:last]
            found = np.flatnonzero(partial_sums)
            scores = partial_sums[found]
            for i in range(lead - 1, -1, -1):
                may = scores + below[i] >= best.bar
                found, scores = found[may], scores[may]
                if not len(found):
                    break
                docs, adds = runs[i]
                place = np.minimum(np.searchsorted(docs, found + begin), len(docs) - 1)
                scores = scores + np.where(docs[place] == found + begin, adds[place], 0)
            good = np.flatnonzero(scores >= best.bar)
            if len(good):
                docs = found[good] + begin
                best.add(scores[good], self.missing[docs], self.keys[docs])


def share(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """50 and 50 times a document's length over the mean, rounded down."""
    if 50 * int(n.max(initial=0)) * documents < 2**63:
        return 50 + 50 * n * documents // length
    return np.array([50 + 50 * int(x) * documents // length for x in n], np.int64)


def _search(shared, k: int, settings: Settings, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best documents of each query among those of the batches."""
    block = shared.value
    best = [_Best(k) for _ in block.items]

    def run(shard: _Shard) -> _Shard:
        if shard.size:
            shard.close()
            for terms, own in zip(block.terms, best):
                shard.search(terms, own)
        return _Shard(block, settings)

    shard = _Shard(block, settings)
    for batch in batches:
        shard.add(batch)
        if shard.postings >= settings.postings:
            shard = run(shard)
    run(shard)
    for item, own in zip(block.items, best):
        if len(own.keys):
            columns = [pa.array([item] * len(own.keys), pa.int64()), pa.array(own.keys, mask=own.missing), pa.array(own.scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])


# ---- search -----------------------------------------------------------------


def search(docs: DataFrame, items: DataFrame, k: int = 50, settings: Settings = Settings(), key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: for every item the ``k`` documents
    with the largest score above zero; equal scores by rising ``doc_id``, those without one last.

    Texts are read whole and a term counts once for an item. Documents without a term, null
    texts among them, are not counted at all; every other row is a document, repeated
    ones as often as they come. Rows of one item id are one item with the terms of all.
    An item that shares no term with a document, and an empty table, give no row. Other
    columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    bound_batches(spark)
    counted = stored(_term_table(docs, key, text), "terms")
    documents, length = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = _term_table(items, item, text).select("key", F.explode(F.split("terms", " ")).alias("term")).distinct()
    asked = stored(asked.groupBy("key").agg(F.collect_list("term").alias("terms")), "items")
    blocks = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // settings.block_terms))
    found = []
    for b in range(blocks):
        block = _block(asked.where(F.pmod(F.xxhash64(F.lit("block"), "key"), F.lit(blocks)) == b).orderBy("key").collect())
        shared = spark.sparkContext.broadcast(block)
        each = counted.mapInArrow(partial(_frequencies, shared), "term long, df long")
        block.weights = np.array([weight(documents, 0)] * len(block.vocabulary), np.int64)
        for r in each.groupBy("term").agg(F.sum("df").alias("df")).collect():
            block.weights[r["term"]] = weight(documents, r["df"])
        block.documents, block.length = documents, length
        ready = spark.sparkContext.broadcast(block)
        found.append(counted.mapInArrow(partial(_search, ready, k, settings), "item_id long, doc_id long, score long"))
    best = reduce(DataFrame.unionByName, found)
    order: list[Column] = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # an item's rows are cut to the best in parts, then as a whole
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(64))
    some = best.withColumn("_place", F.row_number().over(Window.partitionBy("item_id", part).orderBy(*order))).where(F.col("_place") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")

"""Exact top-k search by term-at-a-time accumulation.

Components of the vectors are terms. Rows are dealt by hash into blocks, and a block keeps
a posting list for each term: the rows whose component is not zero, with its value. The
queries are dealt into lots that keep their non-zero components by term as well. A task
meets a block with a lot: term by term the queries scatter their weights times the
postings into a dense array of scores, exactly, in whole numbers; of every query's array
a partition selects the best, which are merged over the blocks of the task, then over all.

Every block meets every lot, as an exhaustive search has to. What is moved for a meeting
is a few megabytes and its work a billion products, so moving stays small beside it at any
size. Memory is bounded by a block, a lot and the scores of ``at_once`` queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segflow.llm.common import bound_batches
from segflow.session import ship, stored


@dataclass(frozen=True)
class Settings:
    """``block``: rows of a block, ``lot``: queries of a lot, on average. ``at_once``: queries
    whose scores are held at a time. ``scale``: what a component is multiplied by before it
    is rounded down. ``tasks``: most tasks that blocks and lots meet in."""

    block: int = 4096
    lot: int = 4096
    at_once: int = 32
    scale: int = 256
    tasks: int = 8192


_PACKED = "key binary, copies binary, offsets binary, places binary, kind string, weights binary"


def finite(vector: Column) -> Column:
    """Not null and without a null or non-finite component; zero and empty ones pass."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


# ---- posting lists ----------------------------------------------------------


def _whole(values: np.ndarray, scale: int) -> np.ndarray:
    """Scaled components rounded down, in the smallest kind of number that holds them."""
    scaled = np.floor(scale * values)
    most = np.abs(scaled).max(initial=0)
    for kind, limit in ((np.int16, 2**15), (np.int32, 2**31), (np.int64, 2**53)):
        if most < limit:
            return scaled.astype(kind)
    # beyond that every double of the size is a whole number
    return np.array([int(v) * scale if abs(v) >= 2**53 else math.floor(scale * v) for v in values.tolist()], object)


def _packer(group: str, scale: int):
    def pack(table: pa.Table) -> pa.Table:
        return _pack(group, scale, table)

    return pack


def _pack(group: str, scale: int, table: pa.Table) -> pa.Table:
    """One row: keys in rising order and, by term, places of the rows that have it and their
    components."""
    table = table.sort_by("key")
    vectors = table.column("vector").combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    term = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weights = _whole(values, scale)
    some = np.flatnonzero(weights != 0)
    order = some[np.argsort(term[some], kind="stable")]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(term[order], minlength=lengths.max(initial=0)))])
    weights = weights[order]
    big = weights.dtype == object
    packed = {
        "key": table.column("key").to_numpy().tobytes(),
        "copies": table.column("copies").to_numpy().tobytes(),
        "offsets": offsets.astype(np.int64).tobytes(),
        "places": row[order].astype(np.int32).tobytes(),
        "kind": "big" if big else weights.dtype.str,
        "weights": b" ".join(b"%d" % w for w in weights) if big else weights.tobytes(),
    }
    return pa.table({group: table.column(group)[:1], **{c: [v] for c, v in packed.items()}})


@dataclass
class _Postings:
    key: np.ndarray
    copies: np.ndarray
    offsets: np.ndarray
    places: np.ndarray
    weights: np.ndarray

    @classmethod
    def read(cls, row: dict, side: str) -> _Postings:
        get = lambda name, kind: np.frombuffer(row[side + name], kind)
        kind = row[f"{side}kind"]
        weights = np.array([int(w) for w in row[f"{side}weights"].split()], object) if kind == "big" else get("weights", kind)
        return cls(get("key", np.int64), get("copies", np.int64), get("offsets", np.int64), get("places", np.int32), weights)

    def most(self) -> int:
        return max(map(abs, (int(self.weights.max()), int(self.weights.min()))), default=0) if len(self.weights) else 0

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.offsets[term], self.offsets[term + 1])
        return self.places[part], self.weights[part]


# ---- scores -----------------------------------------------------------------


def _scores(rows: _Postings, queries: _Postings, first: int, last: int) -> np.ndarray:
    """Scores of the queries in places ``first`` to ``last`` with all rows of a block."""
    terms = min(len(rows.offsets), len(queries.offsets)) - 1
    most = rows.most() * queries.most() * max(terms, 1)
    kind = np.int32 if most < 2**31 else np.int64 if most < 2**63 else object
    scores = np.zeros((last - first, len(rows.key)), kind)
    for term in range(terms):
        asked, weights = queries.of(term)
        part = slice(*np.searchsorted(asked, [first, last]))
        asked, weights = asked[part] - first, weights[part].astype(kind)
        places, values = rows.of(term)
        if not len(asked) or not len(places):
            continue
        added = weights[:, None] * values.astype(kind)[None, :]
        if len(asked) == len(scores) and len(places) == scores.shape[1]:
            scores += added
        else:
            scores[asked[:, None], places[None, :]] += added
    return (np.clip(scores, -(2**63), 2**63 - 1) if kind is object else scores).astype(np.int64)


def _select(k: int, scores: np.ndarray, query: int, key: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores and keys of the k best, other than the query's own key; a row stands for its copies."""
    own = slice(np.searchsorted(key, query, side="left"), np.searchsorted(key, query, side="right"))
    wanted = min(k + own.stop - own.start, len(scores))
    if not wanted:
        return scores[:0], key[:0]
    edge = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
    at = np.flatnonzero(scores >= edge)
    at = at[(at < own.start) | (at >= own.stop)]
    # keys rise within a block; ~ turns the order of all longs around
    at = at[np.argsort(~scores[at], kind="stable")][:k]
    at = np.repeat(at, copies[at])[:k]
    return scores[at], key[at]


def _meet(k: int, at_once: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best rows of each query, merged over the blocks that follow each other with one lot."""
    lot, best = None, {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["_lot"] != lot:
                yield _rows(best)
                lot, best = row["_lot"], {}
            rows, queries = _Postings.read(row, "row_"), _Postings.read(row, "query_")
            for first in range(0, len(queries.key), at_once):
                last = min(first + at_once, len(queries.key))
                for query, scores in zip(queries.key[first:last].tolist(), _scores(rows, queries, first, last)):
                    found, keys = _select(k, scores, query, rows.key, rows.copies)
                    if query in best:
                        found, keys = np.concatenate([best[query][0], found]), np.concatenate([best[query][1], keys])
                        order = np.lexsort((keys, ~found))[:k]
                        found, keys = found[order], keys[order]
                    best[query] = found, keys
    yield _rows(best)


def _rows(best: dict) -> pa.RecordBatch:
    lengths = [len(s) for s, _ in best.values()]
    join = lambda side: np.concatenate([x[side] for x in best.values()]) if best else np.zeros(0, np.int64)
    columns = [np.repeat(np.array(list(best), np.int64), lengths), join(1), join(0)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])


# ---- search -----------------------------------------------------------------


def search(vectors: DataFrame, queries: Column, k: int = 5, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for every row that holds
    ``queries`` the k rows with the largest inner product of the components, each scaled and
    rounded down; ties go to the smaller key.

    All is counted in whole numbers, of any size where 64 bits do not do; a score beyond a long
    becomes the nearest long. Rows without a key, null vectors and those with a null or
    non-finite component take no part; zero vectors do, and a shorter vector counts as ended
    by zeros. A row is not found by a query of its key. Repeated rows are found as often
    as they come; of several queries with one key the one whose vector comes first in order
    is asked. With few rows all are found; an empty table gives no row. Columns other than
    key and vector are read only by ``queries``.
    """
    spark = vectors.sparkSession
    ship(spark)
    bound_batches(spark)
    read = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("_asks"))
    read = read.where(F.col("key").isNotNull() & finite(F.col("vector")))
    # copies of a row, however many, are one row before they are shuffled; more than k are never asked for
    rows = read.groupBy("key", "vector").agg(F.least(F.count("*"), F.lit(k)).cast("long").alias("copies"), F.bool_or("_asks").alias("_asks"))
    rows = stored(rows, "rows")
    total, asked = rows.agg(F.count("*"), F.count_if("_asks")).first()
    blocks, lots = max(1, -(-total // settings.block)), max(1, -(-asked // settings.lot))
    dealt = lambda n, what: F.pmod(F.xxhash64(F.lit(what), "key"), F.lit(n)).cast("int").alias(f"_{what}")
    block = rows.select(dealt(blocks, "block"), "key", "copies", "vector").groupBy("_block")
    block = stored(block.applyInArrow(_packer("_block", settings.scale), f"_block int, {_PACKED}"), "blocks")
    asking = rows.where("_asks").groupBy("key").agg(F.min("vector").alias("vector"), F.lit(1).cast("long").alias("copies"))
    lot = asking.select(dealt(lots, "lot"), "key", "copies", "vector").groupBy("_lot")
    lot = stored(lot.applyInArrow(_packer("_lot", settings.scale), f"_lot int, {_PACKED}"), "lots")
    # the number is fixed: by their bytes alone few meetings would be put into one task
    tasks = min(2 * blocks * lots, settings.tasks)
    names = [c for c in lot.columns if c != "_lot"]
    left = block.select("_block", *[F.col(c).alias(f"row_{c}") for c in names], F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("_lot"))
    right = lot.select("_lot", *[F.col(c).alias(f"query_{c}") for c in names], F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    cell = ["_lot", "_block"]
    met = left.repartition(tasks, *cell).hint("merge").join(right.repartition(tasks, *cell), cell).sortWithinPartitions("_lot")
    found = met.mapInArrow(partial(_meet, k, settings.at_once), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph, which is cut into parts of equal size with few
edges between them. Two small classifiers learn the parts: one places every row, the
other tells in which parts the neighbours of a query lie. A query is compared, exactly,
with all rows of its most probable parts. How many parts that takes is measured on the
sample. Parts are cut into blocks, so no task holds a whole part, and their number grows with
the table. Rows meet only lots of queries that ask for their part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segflow.llm.common import with_python
from segflow.session import ship, stored


@dataclass(frozen=True)
class Settings:
    """``parts``: of the index, at least; one for every ``part_rows`` rows beyond, as long as
    the sample has 32 vectors for each. ``sample``: vectors, on average, that the index is
    fitted on; ``checks`` of them measure recall. ``graph``: neighbours in the graph.
    ``recall``: share of sample neighbours that the routed parts must hold. ``block``,
    ``query_block``: rows and queries that meet in a task. ``rounds``: steps of cutting and
    of learning."""

    parts: int = 16
    part_rows: int = 65536
    sample: int = 8192
    checks: int = 512
    graph: int = 10
    recall: float = 0.95
    block: int = 16384
    query_block: int = 8192
    rounds: int = 150


#: Scores that a task holds at a time.
SCORES = 1 << 22


# ---- vectors ----------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(whole):
        return np.zeros((0, 0))
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1).astype(np.float64)


def _directions(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# ---- graph, parts, classifiers ----------------------------------------------


def neighbours(vectors: np.ndarray, of: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Places in ``among`` of the k largest inner products with ``of``, without itself;
    ``vectors`` holds both."""
    scores = vectors[of] @ vectors[among].T
    scores[of[:, None] == among[None, :]] = -np.inf
    k = min(k, max(len(among) - 1, 0))
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else np.zeros((len(of), 0), int)


def _graph(shared, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vectors = shared.value
    everything = np.arange(len(vectors))
    for batch in batches:
        of = batch.column(0).to_numpy()
        near = neighbours(vectors, of, everything, k)
        yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(list(near), pa.list_(pa.int64()))], names=["node", "near"])


def cut(near: np.ndarray, start: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Parts of equal size (at most 5% above) with few graph edges between them.

    Starts from ``start``, an order of the nodes cut into equal runs; then each node moves
    to the part that holds most of its neighbours, as long as that part has room.
    """
    n = len(near)
    part = np.empty(n, np.int64)
    part[start] = np.arange(n) * parts // max(n, 1)
    room = int(np.ceil(1.05 * n / parts))
    sizes = np.bincount(part, minlength=parts)
    ends = [[] for _ in range(n)]
    for a, row in enumerate(near.tolist()):
        for b in row:
            ends[a].append(b)
            ends[b].append(a)
    for _ in range(rounds):
        moved = 0
        for a in range(n):
            if not ends[a]:
                continue
            held = np.bincount(part[ends[a]], minlength=parts)
            best, own = int(np.argmax(held)), part[a]
            if best != own and held[best] > held[own] and sizes[best] < room:
                sizes[own] -= 1
                sizes[best] += 1
                part[a] = best
                moved += 1
        if moved < n // 200:
            break
    return part


def learn(features: np.ndarray, target: np.ndarray, rounds: int) -> np.ndarray:
    """Weights of a softmax classifier for rows of class shares, by Adam on all rows."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights, m, v = (np.zeros((x.shape[1], target.shape[1])) for _ in range(3))
    for t in range(1, rounds + 1):
        slope = x.T @ (_softmax(x @ weights) - target) / len(x) + 1e-5 * weights
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        weights -= 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return weights


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Index:
    """``items`` places rows by direction and length, ``queries`` routes by direction;
    ``largest`` is the length that counts as one, ``probes`` the parts to look into."""

    items: np.ndarray
    queries: np.ndarray
    largest: float
    probes: int

    def place(self, vectors: np.ndarray) -> np.ndarray:
        length = np.linalg.norm(vectors, axis=1, keepdims=True) / self.largest
        x = np.hstack([vectors / self.largest, np.minimum(length, 1), np.ones((len(vectors), 1))])
        return np.argmax(x @ self.items, axis=1)

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """Parts, most probable first."""
        x = np.hstack([_directions(vectors), np.ones((len(vectors), 1))])
        return np.argsort(-(x @ self.queries), axis=1, kind="stable")


def fit(rows: DataFrame, settings: Settings) -> Index:
    """Fit on about ``settings.sample`` different vectors of ``rows`` (``vector``), chosen by
    hash. The sample comes to the driver; its graph is made in tasks."""
    spark = rows.sparkSession
    ship(spark)
    number = rows.agg(F.count("*")).first()[0]
    dealt = rows.withColumn("_hash", F.xxhash64(F.lit("sample"), "vector"))
    place = F.col("_hash") / F.lit(2.0**64) + 0.5
    chosen = dealt.where(place < settings.sample / max(number, 1)).groupBy("_hash").agg(F.first("vector").alias("vector")).orderBy("_hash").collect()
    vectors = np.array([r["vector"] for r in chosen], np.float64)
    parts = max(1, min(max(settings.parts, number // settings.part_rows), len(vectors) // 32))
    if parts == 1:
        width = vectors.shape[1] if len(vectors) else len((rows.select("vector").first() or [[]])[0])
        return Index(np.zeros((width + 2, 1)), np.zeros((width + 1, 1)), 1.0, 1)
    shared = spark.sparkContext.broadcast(vectors)
    nodes = spark.range(len(vectors)).repartition(8)
    found = nodes.mapInArrow(partial(_graph, shared, max(settings.graph, 20)), "node long, near array<long>").collect()
    near = np.zeros((len(vectors), len(found[0]["near"])), np.int64)
    for r in found:
        near[r["node"]] = r["near"]
    # start along the first principal direction, then by the graph
    centred = vectors - vectors.mean(axis=0)
    start = np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")
    part = cut(near[:, : settings.graph], start, parts)
    largest = float(np.linalg.norm(vectors, axis=1).max())
    own = np.eye(parts)[part]
    length = np.linalg.norm(vectors, axis=1, keepdims=True) / largest
    items = learn(np.hstack([vectors / largest, length]), own, settings.rounds)
    index = Index(items, np.zeros((vectors.shape[1] + 1, parts)), largest, parts)
    placed = index.place(vectors)
    index.queries = learn(_directions(vectors), np.eye(parts)[placed][near].mean(axis=1), settings.rounds)
    # parts needed, by vectors of the sample and their sample neighbours
    some = np.arange(0, len(vectors), max(1, len(vectors) // settings.checks))
    order = index.route(vectors[some])
    rank = np.argsort(order, axis=1)
    needed = np.take_along_axis(rank, placed[near[some]], axis=1)
    share = [(needed < m).mean() for m in range(1, parts + 1)]
    index.probes = next((m for m, s in enumerate(share, 1) if s >= settings.recall), parts)
    return index


# ---- search -----------------------------------------------------------------


def _placer(shared):
    index = shared.value

    def work(vectors: list) -> list:
        return [index.place(np.array(vectors, np.float64)).tolist() if vectors else []]

    return work


def _router(shared, sizes: list[int], k: int):
    index = shared.value
    counts = np.array(sizes)

    def work(vectors: list) -> list:
        if not vectors:
            return [[]]
        out = []
        for order in index.route(np.array(vectors, np.float64)):
            # as many parts as recall needs, and as hold k rows besides the query
            enough = int(np.searchsorted(np.cumsum(counts[order]), k + 1)) + 1
            out.append([int(p) for p in order[: max(index.probes, enough)] if counts[p]])
        return [out]

    return work


def _best(k: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """The k best rows of a block for each query of a block."""
    ids, queries, scores, ranks = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy(), [], []
    if len(ids) and len(queries):
        rows, wanted = _matrix(left.column("vector")), _matrix(right.column("vector"))
        step = max(1, SCORES // len(ids))
        for i, q in enumerate(queries):
            if i % step == 0:
                rough = wanted[i : i + step] @ rows.T
            other = ids != q
            at = np.flatnonzero(other)
            values = rough[i % step][other]
            if len(at) > k:
                # all that may be among the best, then the exact measure, row by row
                edge = np.partition(values, len(values) - k)[len(values) - k]
                at = at[values >= edge - 1e-9 * (1 + abs(edge))]
            exact = (rows[at] * wanted[i]).sum(axis=1)
            order = np.lexsort((ids[at], -exact))[:k]
            ranks.append(np.column_stack([np.full(len(order), q), ids[at][order]]))
            scores.append(exact[order])
    pairs = np.concatenate(ranks).astype(np.int64) if ranks else np.zeros((0, 2), np.int64)
    return pa.table({"query_id": pairs[:, 0], "vec_id": pairs[:, 1], "score": np.concatenate(scores) if scores else np.zeros(0)})


def search(vectors: DataFrame, queries: Column, k: int = 20, settings: Settings = Settings(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for every row that holds
    ``queries`` the k rows found with the largest inner product, in double precision on the
    original vectors; ties go to the smaller key.

    Null and zero vectors and those with a null or non-finite component take no part, nor
    do rows without a key or of another length than most. A row is never its own
    neighbour, and neither is one with its key. Repeated rows are found as often as they come;
    of several queries with one key the one whose vector comes first in order is asked.
    With few rows all are found; an empty table gives no row. Columns other than key and
    vector are read only by ``queries``.
    """
    spark = vectors.sparkSession
    read = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.coalesce(queries, F.lit(False)).alias("_asks"))
    rows = read.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).withColumn("_width", F.size("vector"))
    widths = rows.groupBy("_width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_width").first()
    rows = rows.where(F.col("_width") == (widths["_width"] if widths else 0)).drop("_width")
    shared = spark.sparkContext.broadcast(fit(rows, settings))
    placed = stored(with_python(rows, ["vector"], [T.StructField("part", T.LongType())], partial(_placer, shared)), "placed")
    sizes = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    counts = [sizes.get(p, 0) for p in range(shared.value.items.shape[1])]
    asking = placed.where("_asks").groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    routed = stored(with_python(asking, ["vector"], [T.StructField("_parts", T.ArrayType(T.LongType()))], partial(_router, shared, counts, k)), "routed")
    asked = {r["part"]: r["n"] for r in routed.select(F.explode("_parts").alias("part")).groupBy("part").agg(F.count("*").alias("n")).collect()}
    # every block of a part's rows meets every lot of the queries that ask for the part
    number_of = lambda some: F.get(F.array(*[F.lit(n) for n in some]), F.col("part").cast("int"))
    blocks, lots = number_of([max(1, -(-c // settings.block)) for c in counts]), number_of([-(-asked.get(p, 0) // settings.query_block) for p in range(len(counts))])
    dealt = lambda name, key, among: F.pmod(F.xxhash64(F.lit(name), key), among).cast("int")
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    of = routed.withColumn("part", F.explode("_parts")).drop("_parts").withColumn("_lot", dealt("lot", "query_id", lots))
    of = of.withColumn("_block", F.explode(numbers(blocks)))
    rows = placed.select("vec_id", "vector", "part").where(lots > 0).withColumn("_block", dealt("block", "vec_id", blocks))
    rows = rows.withColumn("_lot", F.explode(numbers(lots)))
    cell = ["part", "_block", "_lot"]
    met = rows.groupBy(*cell).cogroup(of.groupBy(*cell)).applyInArrow(partial(_best, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

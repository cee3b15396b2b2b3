"""Sharding by bytes: differencing of indivisible groups.

Groups of equal texts stay together. Large groups, of which there are few because
they share a bounded total, and bundles of all other groups, whose number is fixed,
are the items. The differencing method of Karmarkar and Karp combines the two
partial partitions of the largest spread, ordered oppositely, until one is left.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import bucket_of, bucket_starts, running_start
from segflow.session import stored

#: Bundles of small groups for each shard. A group above 1 / (shards x BUNDLES) of all
#: bytes is an item of its own, so there are at most 2 x shards x BUNDLES items.
BUNDLES = 256


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item. Ties go by the items' order, so reruns agree."""
    heap = []
    for i, size in enumerate(sizes):
        lots = [(0, None)] * (shards - 1) + [(size, i)]
        heap.append((-size, i, lots))
    heapq.heapify(heap)
    following = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # a and b ascend; the largest lot of one meets the smallest of the other
        met = [(x + y, u if v is None else v if u is None else (u, v)) for (x, u), (y, v) in zip(a, reversed(b))]
        met.sort(key=lambda lot: lot[0])
        least = met[0][0]
        lots = [(x - least, u) for x, u in met]
        heapq.heappush(heap, (-lots[-1][0], following, lots))
        following += 1
    out = [0] * len(sizes)
    for shard, (_, tree) in enumerate(heap[0][2] if heap else []):
        stack = [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            elif node is not None:
                out[node] = shard
    return out


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text, none for null, and 8 for the rest of a row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def digest(text: Column) -> Column:
    """Names a text; null has no bytes, as the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def shard(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key, ``size``, ``text_crc32`` (0 for null, as for no
    bytes), ``shard`` and ``slot``, which numbers the rows of a shard from 0.

    Rows of equal text share a shard; the shards' bytes are as equal as that allows.
    Group sizes are summed before the shuffle, so a hot group is one row there. The
    two small tables that are collected and broadcast have at most 2 x ``shards`` x
    :data:`BUNDLES` rows, whatever the data. Equal rows get neighbouring slots. An
    empty table gives no row; extra columns are not read.
    """
    spark = docs.sparkSession
    column = F.col(text)
    crc = F.coalesce(F.crc32(column.cast("binary")), F.lit(0).cast("long"))
    rows = stored(docs.select(F.col(key).alias("doc_id"), byte_size(column).alias("size"), crc.alias("text_crc32"), digest(column).alias("_digest")), "sizes")
    groups = stored(rows.groupBy("_digest").agg(F.sum("size").alias("_bytes")), "groups")
    total = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0))).first()[0]
    number = shards * BUNDLES
    bundle = F.pmod(F.xxhash64(F.lit("bundle"), "_digest"), F.lit(number)).cast("int")
    large = F.col("_bytes") * number > total
    own = groups.where(large).select("_digest", F.col("_bytes").alias("bytes")).orderBy("_digest").collect()
    packed = groups.where(~large).groupBy(bundle.alias("_bundle")).agg(F.sum("_bytes").alias("bytes")).orderBy("_bundle").collect()
    lots = difference([r["bytes"] for r in own] + [r["bytes"] for r in packed], shards)
    of_group = spark.createDataFrame([(r["_digest"], s) for r, s in zip(own, lots)], "_digest string, _own int")
    of_bundle = spark.createDataFrame([(r["_bundle"], s) for r, s in zip(packed, lots[len(own) :])], "_bundle int, _packed int")
    placed = rows.withColumn("_bundle", bundle).join(F.broadcast(of_group), "_digest", "left").join(F.broadcast(of_bundle), "_bundle", "left")
    placed = placed.withColumn("shard", F.coalesce("_own", "_packed")).withColumn("_bucket", bucket_of("doc_id", "_digest"))
    one = F.lit(1).cast("long")
    starts = bucket_starts(placed, "shard", one)
    slotted = running_start(placed, "shard", one, [F.col("doc_id"), F.col("_digest")], starts)
    return slotted.select("doc_id", "size", "text_crc32", "shard", F.col("_before").alias("slot"))

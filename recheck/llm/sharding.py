"""Shards of near equal bytes by Karmarkar-Karp differencing; documents with equal texts stay together.

Differencing works on partial partitions: tuples of one sum a shard. The two with the largest spread (largest less
smallest sum) are combined, the largest of one with the smallest of the other, until one is left; undoing the
combinations gives each item its shard.

What is combined is bounded, however many rows there are: a group of equal texts with at least 1/``BUNDLES`` of all
bytes is an item of its own (there are ``BUNDLES`` of them at most), all other groups are dealt by their digest into
``BUNDLES`` bundles, which Spark sums up, and each bundle is an item. The few thousand items are combined on the driver,
their shards are broadcast, and a row finds its shard where it is read: texts are hashed there and never shuffled.

Cases: NULL text counts as empty (size 1); NULL doc_id is kept; equal rows are rows of one group; an empty table gives
an empty result; a group above a shard's fair part fills its shard alone. Columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, numbered, quoted

BUNDLES = 16384


def differencing(sizes: list[int], k: int) -> list[int]:
    """The part, 0 to k - 1, of each item."""
    if not sizes:
        return []
    # nodes: parts in descending order of their sums, less the smallest sum; made[i]: children and where parts come from
    made: list[tuple | None] = [None] * len(sizes)
    heap = [(-s, i, (s,) + (0,) * (k - 1)) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        sums = [(x[p] + y[k - 1 - p], p) for p in range(k)]
        sums.sort(key=lambda t: (-t[0], t[1]))
        least = sums[-1][0]
        made.append((a, b, [p for _, p in sums]))
        heapq.heappush(heap, (least - sums[0][0], len(made) - 1, tuple(s - least for s, _ in sums)))
    part = [0] * len(sizes)
    todo = [(heap[0][1], list(range(k)))]  # (node, final part of each of its parts)
    while todo:
        node, final = todo.pop()
        if made[node] is None:
            part[node] = final[0]
            continue
        a, b, came = made[node]
        of_a, of_b = [0] * k, [0] * k
        for p, f in zip(came, final):
            of_a[p], of_b[k - 1 - p] = f, f
        todo += [(a, of_a), (b, of_b)]
    return part


def bundle(digest: Column, bundles: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(bundles)).cast("int")


def shards(docs: DataFrame, k: int = 8, doc_id: str = "doc_id", text: str = "text",
           bundles: int = BUNDLES) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(quoted(text)), F.lit(""))
    base = checkpointed(docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.unhex(F.sha2(t, 256)).alias("digest"),
                                    (F.octet_length(t) + 1).cast("long").alias("size"),
                                    F.crc32(t.cast("binary")).alias("text_crc32")))
    groups = checkpointed(base.groupBy("digest").agg(F.sum("size").alias("bytes")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    own = F.col("bytes") * bundles >= total  # at most ``bundles`` groups
    heavy = [(bytes(r[0]), r[1]) for r in groups.where(own).orderBy("digest").collect()]
    light = [tuple(r) for r in groups.where(~own).groupBy(bundle(F.col("digest"), bundles).alias("b")).agg(
        F.sum("bytes")).orderBy("b").collect()]
    part = differencing([s for _, s in heavy + light], k)
    of_heavy = spark.createDataFrame([(d, p) for (d, _), p in zip(heavy, part)], "digest binary, own int")
    of_light = spark.createDataFrame([(b, p) for (b, _), p in zip(light, part[len(heavy):])], "b int, dealt int")
    placed = checkpointed(
        base.join(F.broadcast(of_heavy), "digest", "left").withColumn("b", bundle(F.col("digest"), bundles))
        .join(F.broadcast(of_light), "b", "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own", "dealt").alias("shard")))
    return numbered(placed, ["shard"], "slot")

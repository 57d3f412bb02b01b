"""Exact dedup with a heavy-hitter split.

Texts are equal when identical after lower-casing A-Z; a NULL text counts as empty. Groups are found by SHA-256 of the
normalised text. A Misra-Gries pass over the digests finds every digest that holds at least a ``SHARE`` of all rows;
exact counts verify them, and the few winners are broadcast, so that rows of hot groups are decided where they are read.
All other digests hold less than that share and go through an ordinary shuffle.

Bounds: a partition keeps ``COUNTERS`` counters at most. The sum of a digest's counters over all partitions falls short
of its count by n / (COUNTERS + 1) at most, so digests whose sum reaches (SHARE - 1 / (COUNTERS + 1)) * n include every
digest with SHARE * n rows, and there are at most 1 / (SHARE - 1 / (COUNTERS + 1)) of them, however many rows there are.

Cases: NULL doc_id orders below every number; of rows equal in doc_id and text exactly one stays; an empty table gives
an empty result; extra columns are ignored by ``groups`` and kept by ``dedup``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recheck.llm.common import ascii_lower, checkpointed, fresh, quoted

SHARE = 1 / 256
COUNTERS = 1023


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))), 256))


def misra_gries(counts: Counter, more: Counter, k: int = COUNTERS) -> Counter:
    """Merges two summaries: counts are added, then the (k+1)th largest is taken off all of them."""
    counts.update(more)
    if len(counts) > k:
        cut = sorted(counts.values(), reverse=True)[k]
        counts = Counter({d: c - cut for d, c in counts.items() if c > cut})
    return counts


def summaries(base: DataFrame, k: int = COUNTERS) -> DataFrame:
    """(digest, counted): the Misra-Gries counters of each partition of ``base``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for b in batches:
            seen = misra_gries(seen, Counter(b.column(0).to_pylist()), k)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                         names=["digest", "counted"])

    return base.select("digest").mapInArrow(scan, "digest binary, counted bigint")


def heavy(base: DataFrame, share: float = SHARE, k: int = COUNTERS) -> DataFrame:
    """Exact (digest, n, best) of every digest that may hold ``share`` of the rows of ``base`` (digest, doc_id, rid);
    best is the row that stays. At most 1 / (share - 1 / (k + 1)) rows."""
    n = base.count()
    least = (share - 1 / (k + 1)) * n
    found = summaries(base, k).groupBy("digest").agg(F.sum("counted").alias("s")).where(F.col("s") >= least)
    rows = base.join(F.broadcast(found.select("digest")), "digest", "left_semi")
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(order()).alias("best"))


def order() -> Column:
    """Larger for the row that stays: the largest doc_id, and of rows with one doc_id the first one read."""
    return F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), (-F.col("rid")).alias("r"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest."""
    base = checkpointed(docs.select(F.col(quoted(doc_id)).alias("doc_id"), digest(F.col(quoted(text))).alias("digest")))
    base = base.withColumn("rid", F.monotonically_increasing_id())
    winners = checkpointed(heavy(base))
    split = base.join(F.broadcast(winners), "digest", "left")
    hot = split.where(F.col("n").isNotNull()).select(
        "doc_id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("best.r") == -F.col("rid")).alias("kept"), "digest")
    same = Window.partitionBy("digest")
    rest = (split.where(F.col("n").isNull()).select("doc_id", "digest", "rid")
            .withColumn("best", F.max(order()).over(same)).withColumn("n", F.count(F.lit(1)).over(same))
            .select("doc_id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
                    (F.col("best.r") == -F.col("rid")).alias("kept"), "digest"))
    return hot.unionByName(rest)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows of hot groups other than the winner's doc_id are dropped before the shuffle; the rest meets by digest."""
    d, best, at = (fresh(docs, x) for x in ("_digest", "_best", "_at"))
    base = checkpointed(docs.select(F.col(quoted(doc_id)).alias("doc_id"), digest(F.col(quoted(text))).alias("digest")))
    winners = checkpointed(heavy(base.withColumn("rid", F.monotonically_increasing_id()))
                           .select(F.col("digest").alias(f"{d}2"), F.struct(F.col("best.id").alias("id")).alias(best)))
    own = F.col(quoted(doc_id))
    left = (docs.withColumn(d, digest(F.col(quoted(text))))
            .join(F.broadcast(winners), F.col(d) == F.col(f"{d}2"), "left")
            .where(F.col(best).isNull() | own.eqNullSafe(F.col(f"{best}.id"))))
    first = Window.partitionBy(d).orderBy(own.desc_nulls_last())
    return (left.withColumn(at, F.row_number().over(first)).where(F.col(at) == 1)
            .select(*[F.col(quoted(c)) for c in docs.columns]))

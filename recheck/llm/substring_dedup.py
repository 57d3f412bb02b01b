"""Substring dedup: words go that lie in a window of ``WINDOW`` words which also starts in a document of smaller id.

The corpus becomes a sparse de Bruijn graph over its words. Some of the k-word runs (k = ``K``) are anchors, about one
in 12; a run's own words say whether it is one, and every window holds one (closed syncmers). So equal windows hold equal
anchors at equal places. Anchors are the graph's nodes; the words from one anchor to the end of the next are an edge.

1. Only anchors that occur in two documents at least are kept. A node with one and the same edge behind it (before it)
   in all its occurrences does not branch there. Where an edge leaves such a node and enters such a node, the two are
   compacted: joins of the occurrences with per-node and per-edge counts mark these edges, and running sums over a
   document number its paths. All occurrences of a path have the same words, in the same documents.
2. A window that repeats holds an anchor, and the edges inside it repeat; so it lies inside a path, or it reaches over
   the end of one, but not as far as a whole edge that does not repeat. Paths of 50 words or more are one candidate
   each; of the windows over the ends of paths, each is a candidate.
3. Candidates are verified at their coordinates: the words there are read again and hashed to 128 bits, and a candidate
   counts if its words also stand in a document of smaller id. What they cover is cut out of the text.

Bounds: documents with candidates find their way through ``BUCKETS`` bucket numbers at most, which are broadcast, so
texts of other documents are never shuffled. Lists are per document, as long as the text at most. Joins are on hashes
with both sides written before, so that Spark can split a hot anchor or window.

Cases: a NULL text has no words; rows with a NULL id are neither source nor cut; rows of one id are no smaller than each
other; rows equal in id and text are cut alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, quoted
from recheck.llm.shingle_hashes import Hashes, anchors
from recheck.session import ensure_checkpoint_dir

WINDOW = 50
# Anchors of 26 words: 24 of them in a row hold one, and a window has 25.
K = 26
BUCKETS = 1 << 20


def anchor_rows(docs: DataFrame, k: int, window: int) -> DataFrame:
    """One row an anchor of ``docs`` (doc, tx, text): doc, tx, i (its number), p (its first word), before and behind
    (words to the anchors on either side, or to where they would have to be), a (its hash), e (the edge behind it)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            rows: list[np.ndarray] = []
            for row, text in enumerate(b.column(2).to_pylist()):
                h = Hashes(text.split())
                p, a = anchors(h, k, window)
                if not len(p):
                    continue
                gaps = np.diff(np.concatenate([[-1], p, [h.n - k + 1]]))
                e = h.runs(p, np.append(p[1:] + k, 0), 1)[0]
                rows.append(np.full(len(p), row))
                for c, v in zip(cols, (np.arange(len(p)), p, gaps[:-1], gaps[1:], a.view(np.int64), e.view(np.int64))):
                    c.append(v)
            at = np.concatenate(rows) if rows else np.zeros(0, int)
            i, p, before, behind, a, e = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in cols)
            last = np.append(at[1:] != at[:-1], True) if len(at) else np.zeros(0, bool)
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(take), b.column(1).take(take), pa.array(i, pa.int32()), pa.array(p, pa.int32()),
                 pa.array(before, pa.int16()), pa.array(behind, pa.int16()), pa.array(a, pa.int64()),
                 pa.array(e, pa.int64(), mask=last)],
                names=["doc", "tx", "i", "p", "before", "behind", "a", "e"])

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.select("doc", "tx", F.col("text").cast("binary")).mapInArrow(
        scan, f"doc {kind}, tx bigint, i int, p int, before smallint, behind smallint, a bigint, e bigint")


def paths(found: DataFrame, k: int) -> DataFrame:
    """(doc, tx, paths): of each document with repeated anchors its paths, each with first and last (first words of
    its end anchors), low and high (where a window over its ends may start and end)."""
    nodes = checkpointed(found.groupBy("a").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                         .where("lo < hi").select("a"))
    in_order = Window.partitionBy("doc", "tx").orderBy("i")
    alike = F.col("i") == F.lag("i").over(in_order) + 1
    # equal rows count once; the window keeps the partitions that this is done in
    seen = checkpointed(found.join(nodes, "a").repartition("doc", "tx").dropDuplicates(["doc", "tx", "i"])
                        .withColumn("e_before", F.when(alike, F.lag("e").over(in_order))))

    def one(col: str, name: str):
        return ((F.min(col) == F.max(col)) & (F.count(col) == F.count(F.lit(1)))).alias(name)

    sides = checkpointed(seen.groupBy("a").agg(one("e", "one_behind"), one("e_before", "one_before")).select(
        "a", F.coalesce("one_behind", F.lit(False)).alias("one_behind"),
        F.coalesce("one_before", F.lit(False)).alias("one_before")))
    edges = checkpointed(seen.where(F.col("e").isNotNull()).groupBy("e").agg(
        F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("e", F.lit(True).alias("repeats")))
    known = seen.join(sides, "a").join(edges, "e", "left")
    next_ = F.lead("i").over(in_order) == F.col("i") + 1
    marked = (known.withColumn("edge", F.coalesce(next_ & F.col("repeats"), F.lit(False)))
              .withColumn("compact", F.col("edge") & F.col("one_behind") & F.coalesce(
                  F.lead("one_before").over(in_order), F.lit(False)))
              .withColumn("entered", F.coalesce(F.lag("compact").over(in_order), F.lit(False)))
              .withColumn("linked", F.coalesce(F.lag("edge").over(in_order), F.lit(False)))
              .withColumn("path", F.sum(F.when(F.col("entered"), 0).otherwise(1)).over(in_order)))
    each = marked.groupBy("doc", "tx", "path").agg(
        F.min("p").alias("first"), F.max("p").alias("last"),
        F.min_by(F.struct("before", "linked"), "i").alias("left"), F.max_by(F.struct("behind", "edge"), "i").alias("right"))
    # beyond an edge that repeats, windows may go on as far as they reach; the next path's own range takes over there
    low = F.when(F.col("left.linked"), F.lit(-1)).otherwise(F.col("first") - F.col("left.before") + 1)
    high = F.when(F.col("right.edge"), F.lit(-1)).otherwise(F.col("last") + F.col("right.behind") + k - 1)
    return each.groupBy("doc", "tx").agg(F.sort_array(F.collect_list(
        F.struct("first", "last", low.alias("low"), high.alias("high")))).alias("paths"))


def candidate_starts(found: list[tuple[int, int, int, int]], n: int, k: int,
                     window: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Of the paths of a text of ``n`` words: (first, last) window starts inside each path, and the starts of the windows
    that reach over an end of a path."""
    inside, over = [], np.zeros(n + 1, bool)
    lows, highs = [p[2] for p in found], [p[3] for p in found]
    for j in range(1, len(found)):  # linked paths: the outermost bounds count
        if lows[j] < 0:
            lows[j] = lows[j - 1]
    for j in range(len(found) - 2, -1, -1):
        if highs[j] < 0:
            highs[j] = highs[j + 1]
    for (first, last, _, _), low, high in zip(found, lows, highs):
        over[max(0, low, first + k - window): max(0, min(last, high - window, n - window) + 1)] = True
    for first, last, _, _ in found:
        if last + k - window >= first:
            inside.append((first, last + k - window))
            over[first: last + k - window + 1] = False
    return inside, np.flatnonzero(over)


def candidates(docs: DataFrame, found: DataFrame, k: int, window: int) -> DataFrame:
    """(h1, h2, doc, tx, s0, s1): the words of each candidate as a 128-bit hash, and the windows it stands for: those
    that start at s0 to s1."""
    kind = docs.schema["doc"].dataType.simpleString()
    rows = docs.join(found.withColumnsRenamed({"doc": "doc2", "tx": "tx2"}),
                     (F.col("doc") == F.col("doc2")) & (F.col("tx") == F.col("tx2"))).select(
        "doc", "tx", F.col("text").cast("binary").alias("text"), "paths.first", "paths.last", "paths.low", "paths.high")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                h = Hashes(b.column(2)[r].as_py().split())
                ends = list(zip(*(b.column(c)[r].as_py() for c in range(3, 7))))
                inside, over = candidate_starts(ends, h.n, k, window)
                s0 = np.concatenate([[s for s, _ in inside], over]).astype(np.int64)
                s1 = np.concatenate([[s for _, s in inside], over]).astype(np.int64)
                if not len(s0):
                    continue
                words = h.runs(s0, s1 + window)
                same = pa.array(np.full(len(s0), r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[0].view(np.int64)), pa.array(words[1].view(np.int64)), b.column(0).take(same),
                     b.column(1).take(same), pa.array(s0, pa.int32()), pa.array(s1, pa.int32())],
                    names=["h1", "h2", "doc", "tx", "s0", "s1"])

    return rows.mapInArrow(read, f"h1 bigint, h2 bigint, doc {kind}, tx bigint, s0 int, s1 int")


def spans(docs: DataFrame, k: int = K, window: int = WINDOW) -> DataFrame:
    """(doc, tx, cut): of each document (doc, tx, text) with repeated windows, [(first start, last start), ...]."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/substrings-{uuid.uuid4().hex}"
    known = docs.where(F.col("doc").isNotNull() & F.col("text").isNotNull())
    anchor_rows(known, k, window).write.parquet(f"{folder}/anchors")
    found = checkpointed(paths(spark.read.parquet(f"{folder}/anchors"), k))
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/anchors"), True)
    candidates(among(known, found), found, k, window).write.parquet(f"{folder}/candidates")
    read = spark.read.parquet(f"{folder}/candidates")
    sources = checkpointed(read.groupBy("h1", "h2").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                           .where("lo < hi").select("h1", "h2", "lo"))
    out = checkpointed(read.join(sources, ["h1", "h2"]).where("doc > lo").groupBy("doc", "tx").agg(
        F.sort_array(F.collect_set(F.struct("s0", "s1"))).alias("cut")))
    files.delete(top, True)
    return out


def bucket(doc: str, tx: str):
    return F.pmod(F.xxhash64(doc, tx), F.lit(BUCKETS)).cast("int")


def among(docs: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` that may be in ``found`` by their bucket; with left_anti those that can't be."""
    numbers = found.select(bucket("doc", "tx").alias("_b")).distinct()  # at most BUCKETS rows
    return docs.withColumn("_b", bucket("doc", "tx")).join(F.broadcast(numbers), "_b", how).drop("_b")


def cut_texts(rows: DataFrame, window: int, texts: bool) -> DataFrame:
    """``rows`` (doc, text, s0, s1) as doc, n_words, n_removed, kept_sha256, and with ``texts`` kept_text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, sha, kept = [], [], [], []
            for text, s0, s1 in zip(*(b.column(c).to_pylist() for c in (1, 2, 3))):
                words = (text or b"").split()
                n = len(words)
                if s0:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, np.array(s0), 1)
                    np.add.at(edge, np.array(s1) + window, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:n]) == 0).tolist()]
                left = b" ".join(words)
                n_words.append(n)
                n_removed.append(n - len(words))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
            cols = [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * texts,
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts)

    kind = rows.schema["doc"].dataType.simpleString()
    return rows.select("doc", F.col("text").cast("binary"), "s0", "s1").mapInArrow(
        cut, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * texts)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW,
          texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (kept words, joined by one blank); with ``texts``
    the kept text too."""
    own = docs.select(F.col(quoted(doc_id)).alias("doc"), F.col(quoted(text)).cast("string").alias("text")).withColumn(
        "tx", F.xxhash64("text"))
    found = spans(own, k, window)
    none = F.lit(None).cast("array<int>")
    hit = among(own, found).join(found.withColumnsRenamed({"doc": "doc2", "tx": "tx2"}), (
        F.col("doc") == F.col("doc2")) & (F.col("tx") == F.col("tx2")), "left").select(
        "doc", "text", "cut.s0", "cut.s1")
    rest = among(own, found, "left_anti").select("doc", "text", none.alias("s0"), none.alias("s1"))
    return cut_texts(hit, window, texts).unionByName(cut_texts(rest, window, texts))

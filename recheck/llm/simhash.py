"""SimHash near-dedup: a binary trie self-join over the fingerprints, then connected components.

Fingerprints: words of the text (A-Z lower-cased), shingles of 4 words with repeats, XXH64 of each; a bit is set where
over half of the hashes have it. Equal fingerprints are one class from here on.

Join: all pairs of classes within ``MAX_BITS`` bits. The bits are cut into ``MAX_BITS + 1`` blocks, and there is a trie
for each, over the fingerprints rotated to put that block first: a pair within the budget agrees on at least one block,
so it meets in that trie under one node of the block's depth. From there pairs of nodes are walked together, the
differing bits of their paths are added up, and a pair above the budget is dropped with all that is below it. Spark
walks node pairs down as long as they hold more than ``NODE_ROWS`` classes (it joins counts of prefixes, 4 bits a step),
so a node that holds any part of all rows ends up in many tasks. The remaining node pairs are dealt into groups of about
``NODE_ROWS`` classes and finished in NumPy, bit by bit, at most ``PAIR_BLOCK`` pairs at a time. There, subtrees that
are one component already are dropped too, so dense groups cost no quadratic output: a group gives each class a link to
the smallest class it is connected with, at most one link a class.

Components: labels sink along the links (smallest neighbour, the label's own label hooked on too, then jumps), each
round checkpointed, until nothing changes.

Cases: texts without words (NULL, empty) have fingerprint zero and are one class; NULL ids never are a component's id
unless all of its ids are NULL; repeated rows are in one class; an empty table gives an empty result; columns other than
id and text are not read by ``components`` and are kept by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, quoted, row_key, take_copies

SHINGLE = 4
MAX_BITS = 4
SEED = 42
NODE_ROWS = 1 << 15
STEP_BITS = 4
# Node pairs of one group that are held at a time.
PAIR_BLOCK = 1 << 18
# Shingles of one text that are hashed at a time.
HASH_BLOCK = 1 << 18

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")  # (256, 8)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a text in UTF-8."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[min(shingle, len(words)) - 1:]
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASH_BLOCK):
        some = np.array([h(joined[a:b], SEED) for a, b in zip(starts[at: min(n, at + HASH_BLOCK)].tolist(),
                                                              last[at: at + HASH_BLOCK].tolist())], np.uint64)
        byte = some.view(np.uint8).reshape(-1, 8) + np.arange(8, dtype=np.uint16) * 256
        ones += (np.bincount(byte.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, doc_id: str, text: str, *more: Column, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (as a signed 64-bit number) and ``more`` columns of each row."""
    rows = docs.select(F.col(quoted(text)).cast("binary").alias("text"), F.col(quoted(doc_id)).alias("doc_id"), *more)
    kept = rows.columns[1:]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t or b"", shingle) for t in b.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(fps.view(np.int64))], names=[*kept, "fp"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(scan, f"{schema}, fp bigint")


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit from the left, length) of max_bits + 1 blocks that cover the 64 bits."""
    k = max_bits + 1
    edges = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def rotated(fp: Column, by: int) -> Column:
    """The 64 bits moved to the left by ``by``, those that leave at the left coming in again at the right."""
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def unsigned_shift(col: Column, by: Column) -> Column:
    return F.call_function("shiftrightunsigned", col, by)


def node_pairs(classes: DataFrame, max_bits: int, node_rows: int) -> DataFrame:
    """(block, steps, bucket, a, b, err, r): the classes under each node pair that is small enough. Node pairs of one
    depth share buckets of about ``node_rows`` rows."""
    starts = blocks(max_bits)
    each = F.explode(F.array(*[F.struct(F.lit(j).alias("block"), F.lit(length).alias("depth"),
                                        rotated(F.col("fp"), start).alias("r"))
                               for j, (start, length) in enumerate(starts)]))
    tries = checkpointed(classes.select(each.alias("x")).select("x.*"))

    def prefix(steps: int) -> Column:
        return unsigned_shift(F.col("r"), 64 - F.col("depth") - steps * STEP_BITS)

    def nodes(steps: int) -> DataFrame:
        return tries.groupBy("block", prefix(steps).alias("node")).agg(F.count(F.lit(1)).alias("n"))

    pairs = checkpointed(nodes(0).where("n > 1").select(
        "block", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("err"), F.col("n").alias("na"),
        F.col("n").alias("nb")))
    rows = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
    most_steps = (64 - max(n for _, n in starts)) // STEP_BITS
    out, steps = None, 0
    while True:
        small = pairs if steps == most_steps else pairs.where(rows <= node_rows)
        n = small.agg(F.sum(rows)).first()[0] or 0
        buckets = -(-n // node_rows)
        if buckets:
            ends = small.select("block", "a", "b", "err", F.pmod(F.xxhash64("block", "a", "b"), F.lit(buckets)).alias(
                "bucket"), F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))
            held = (tries.withColumn("node", prefix(steps)).join(ends, ["block", "node"])
                    .select("block", F.lit(steps).alias("steps"), "bucket", "a", "b", "err", "r"))
            out = held if out is None else out.unionByName(held)
        pairs = pairs.where(rows > node_rows)
        if steps == most_steps or pairs.isEmpty():
            return out if out is not None else tries.where("false").select(
                "block", F.lit(0).alias("steps"), F.lit(0).cast("long").alias("bucket"), F.col("r").alias("a"),
                F.col("r").alias("b"), F.lit(0).alias("err"), "r")
        steps += 1
        below = checkpointed(nodes(steps).withColumn("up", unsigned_shift(F.col("node"), F.lit(STEP_BITS))))
        left = below.select("block", F.col("up").alias("a"), F.col("node").alias("a2"), F.col("n").alias("na2"))
        right = below.select("block", F.col("up").alias("b"), F.col("node").alias("b2"), F.col("n").alias("nb2"))
        # a node paired with itself gives each pair of its children once
        pairs = checkpointed(
            pairs.join(left, ["block", "a"]).join(right, ["block", "b"])
            .where((F.col("a") != F.col("b")) | (F.col("a2") <= F.col("b2")))
            .withColumn("err", F.col("err") + F.bit_count(F.col("a2").bitwiseXOR(F.col("b2")))
                        - F.bit_count(F.col("a").bitwiseXOR(F.col("b"))))
            .where((F.col("err") <= max_bits) & ((F.col("a2") != F.col("b2")) | (F.col("na2") > 1)))
            .select("block", F.col("a2").alias("a"), F.col("b2").alias("b"), "err", F.col("na2").alias("na"),
                    F.col("nb2").alias("nb")))


def walk(x: np.ndarray, first: np.ndarray, depth: int, max_bits: int) -> np.ndarray:
    """Root (an index into ``x``, the smallest of its component) of each class, after joining every pair within the
    budget under the node pairs ``first``: rows of (first and end index of a node, the same of the other, differing bits
    of their paths). ``x``: sorted, distinct; the nodes have paths of ``depth`` bits."""
    root = np.arange(len(x))

    def join(i: np.ndarray, k: np.ndarray) -> None:
        nonlocal root
        while len(i):
            low, high = np.minimum(root[i], root[k]), np.maximum(root[i], root[k])
            differ = low != high
            i, k = i[differ], k[differ]
            np.minimum.at(root, high[differ], low[differ])
            while not np.array_equal(up := root[root], root):
                root = up

    stack = [(depth, first)]
    while stack:
        depth, p = stack.pop()
        change = np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])
        one = ((change[p[:, 1] - 1] == change[p[:, 0]]) & (change[p[:, 3] - 1] == change[p[:, 2]])
               & (root[p[:, 0]] == root[p[:, 2]]))
        p = p[~one]
        single = (p[:, 1] - p[:, 0] == 1) & (p[:, 3] - p[:, 2] == 1)
        i, k = p[single, 0], p[single, 2]
        near = np.bitwise_count(x[i] ^ x[k]) <= max_bits
        join(i[near], k[near])
        p = p[~single]
        if not len(p):
            continue
        alo, ahi, blo, bhi, err = p.T
        bit = np.uint64(1) << np.uint64(63 - depth)
        amid, bmid = cut(x, alo, ahi, bit), cut(x, blo, bhi, bit)
        equal = np.concatenate([np.stack([alo, amid, blo, bmid, err], 1), np.stack([amid, ahi, bmid, bhi, err], 1)])
        other = np.concatenate([np.stack([alo, amid, bmid, bhi, err + 1], 1),
                                np.stack([amid, ahi, blo, bmid, err + 1], 1)[(alo != blo) | (ahi != bhi)]])
        for q in (other[other[:, 4] <= max_bits], equal):  # those that agree come off the stack first: they join most
            q = q[(q[:, 1] > q[:, 0]) & (q[:, 3] > q[:, 2])]
            q = q[(q[:, 0] != q[:, 2]) | (q[:, 1] != q[:, 3]) | (q[:, 1] - q[:, 0] > 1)]
            stack += [(depth + 1, q[at: at + PAIR_BLOCK]) for at in range(0, len(q), PAIR_BLOCK)]
    return root


def cut(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """First index in [lo, hi) of sorted ``x`` whose ``bit`` is set; rows of a range agree on all bits before it."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        set_ = (x[np.minimum(mid, len(x) - 1)] & bit) != 0
        hi = np.where(open_ & set_, mid, hi)
        lo = np.where(open_ & ~set_, mid + 1, lo)


def links(classes: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """(a, b): each class of a node pair that is linked there, and the smallest class it is connected with there."""
    starts = blocks(max_bits)

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        start, length = starts[int(rows["block"].iloc[0])]
        depth = length + int(rows["steps"].iloc[0]) * STEP_BITS
        x = np.unique(rows["r"].to_numpy(np.int64).view(np.uint64))
        node = (x >> np.uint64(64 - depth)).astype(np.int64)
        p = rows[["a", "b", "err"]].drop_duplicates().to_numpy(np.int64)
        first = np.stack([np.searchsorted(node, p[:, 0], "left"), np.searchsorted(node, p[:, 0], "right"),
                          np.searchsorted(node, p[:, 1], "left"), np.searchsorted(node, p[:, 1], "right"), p[:, 2]], 1)
        root = walk(x, first, depth, max_bits)
        if start:
            x = (x >> np.uint64(start)) | (x << np.uint64(64 - start))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": x[moved].view(np.int64), "b": x[root[moved]].view(np.int64)})

    return node_pairs(classes, max_bits, node_rows).groupBy("block", "steps", "bucket").applyInPandas(
        group, "a bigint, b bigint")


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node connected with each node of ``edges`` (a, b)."""
    both = checkpointed(edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).select("x.*").distinct())
    labels = checkpointed(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select(
        "node", F.least("node", "m").alias("label")))
    while True:
        around = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("m"))
        seen = checkpointed(labels.withColumnRenamed("node", "u").join(around, "u").select(
            "u", "label", F.least("label", "m").alias("m")))
        # what a node has seen goes to the node and to the node it had as its label
        sunk = checkpointed(seen.select(F.explode(F.array("u", "label")).alias("u"), "m").groupBy("u").agg(
            F.min("m").alias("m")))
        jump = sunk.select(F.col("u").alias("m"), F.col("m").alias("mm"))
        new = checkpointed(sunk.join(jump, "m").select(F.col("u").alias("node"), F.least("m", "mm").alias("label")))
        changed = new.join(labels.withColumnRenamed("label", "old"), "node").where("label != old")
        if changed.isEmpty():
            return new
        labels = new


def labelled(rows: DataFrame, max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """``rows`` (doc_id, fp, ...; checkpointed) with ``label``, a fingerprint that stands for the component, and
    ``component_id``."""
    classes = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = connected(links(classes.select("fp"), max_bits, node_rows))
    grouped = checkpointed(classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")))
    ids = checkpointed(grouped.groupBy("label").agg(F.min("least").alias("component_id")))
    known = checkpointed(grouped.join(ids, "label").select(F.col("fp").alias("fp2"), "label", "component_id"))
    return rows.join(known, F.col("fp") == F.col("fp2")).drop("fp2")


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id."""
    rows = checkpointed(fingerprints(docs, doc_id, text, shingle=shingle))
    return labelled(rows, max_bits, node_rows).select("doc_id", "fp", "component_id")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
          max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component with all its columns: the one with the smallest doc_id."""
    rows = checkpointed(fingerprints(docs, doc_id, text, row_key(docs).alias("key"), shingle=shingle))
    own = labelled(rows, max_bits).groupBy("label", "doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    stays = own.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"),
                                                    F.col("doc_id").alias("id"), "key", "n")).alias("x"))
    return take_copies(docs, doc_id, stays.select("x.id", "x.key", F.lit(1).alias("copies"), "x.n"))

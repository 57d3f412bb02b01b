"""Hard negatives by anchor spanning-tree bounds.

A hard negative of an anchor row is a row of another label whose score (inner product of quantised vectors) is close
below that of a positive, a row of the anchor's label. Anchors come in blocks of similar ones, and a block's anchors are
linked by a minimum spanning tree. The scores of the tree's root with a block of candidates are computed; for any other
anchor they lie within its parent's bounds, plus or minus the length of the edge times the candidate's norm. Only
candidates whose bounds overlap what is looked for (the best scores so far, or the window below a positive) are scored
themselves; the others hand on their bounds to the next edge.

All anchors meet all rows, in blocks: rows stay where they are, and waves of anchors, of ``WAVE_BYTES`` each, are
broadcast one after the other. A task keeps the best few of each anchor and window only. A wave has two scans: the first
finds the positives, the second the negatives in their windows. Components are floor(SCALE * x); scores are exact
integers.

Cases: rows with a NULL id, label or vector, or a NULL or non-finite component take no part; equal rows (id, label and
vector) count as one, rows of one id with other contents each for themselves, but never as a positive of their own id;
vectors of different lengths have no score with each other; ties go to the smaller id, then the smaller label and
hash of the vector; scores outside 64 bits are held at its ends; windows below a negative positive are empty; columns other than id,
vector and label are not read; an empty table, or none that is an anchor, gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, quoted
from recheck.session import ensure_checkpoint_dir

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # percent of a positive's score between which a negative's lies
ANCHORS = 256  # in a block, with one tree
ROWS = 4096  # candidates looked at together
WAVE_BYTES = 1 << 25
_EXACT = 2.0 ** 53
_LIMIT = 2 ** 63 - 1
_FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
_HITS = "anchor bigint, slot int, vec_id bigint, label bigint, tie bigint, score bigint"


def products(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``x`` with ``v``: float64 holds them, or else Python's integers do."""
    if not x.size:
        return np.zeros(len(x))
    if np.abs(x).max() * max(np.abs(v).max(), 1.0) * x.shape[1] < _EXACT:
        return x @ v
    whole = [sum(int(a) * int(b) for a, b in zip(row, v)) for row in x]
    return np.array([min(max(s, -_LIMIT - 1), _LIMIT) for s in whole], object)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of a minimum spanning tree (Prim): ``order`` begins at the row nearest to the mean, each
    parent stands before its children, ``edge`` is the distance to the parent (0 at the root)."""
    n = len(x)
    root = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    order, parent, edge = [root], np.full(n, -1), np.zeros(n)
    far, near = ((x - x[root]) ** 2).sum(1), np.full(n, root)
    far[root] = np.inf
    for _ in range(n - 1):
        i = int(far.argmin())
        parent[i], edge[i] = near[i], np.sqrt(far[i])
        order.append(i)
        d = ((x - x[i]) ** 2).sum(1)
        closer = d < far
        far = np.where(closer & np.isfinite(far), d, far)
        near[closer] = i
        far[i] = np.inf
    return np.array(order), parent, edge


@dataclass
class Block:
    """Anchors with their tree. ``windows``: of each anchor the (slot, lowest score, highest score) looked for."""
    number: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    order: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    windows: list[list[tuple[int, float, float]]]


class Best:
    """The ``k`` best (score, id, label, tie) of one anchor and window among the candidates seen so far."""

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high, self.rows = k, low, high, []

    def add(self, score: np.ndarray, vec_id: np.ndarray, label: np.ndarray, tie: np.ndarray) -> None:
        at = np.flatnonzero((score >= self.low) & (score <= self.high))
        if len(at) > self.k:  # what reaches the k-th best score, ties included
            own = score[at].astype(float)
            at = at[own >= np.partition(own, -self.k)[-self.k]]
        if len(at) > 4 * self.k and score.dtype != object:  # many ties
            at = at[np.lexsort((tie[at], label[at], vec_id[at], -score[at]))[: self.k]]
        if len(at):
            new = [(-int(score[i]), int(vec_id[i]), int(label[i]), int(tie[i])) for i in at]
            self.rows = sorted(self.rows + new)[: self.k]
            if len(self.rows) == self.k:
                self.low = max(self.low, -self.rows[-1][0])


def searched(block: Block, best: list[list[Best]], x: np.ndarray, vec_id: np.ndarray, label: np.ndarray,
             tie: np.ndarray, same: bool) -> int:
    """Adds the candidates (those of the anchor's label, or the others) to ``best``; how many scores were computed."""
    norm, everyone = np.sqrt((x * x).sum(1)), np.arange(len(x))
    low, high = np.empty((len(block.order), len(x))), np.empty((len(block.order), len(x)))
    scored = 0
    for a in block.order:
        p = block.parent[a]
        may = (label == block.label[a]) & (vec_id != block.vec_id[a]) if same else label != block.label[a]
        if p < 0:
            at = everyone
        else:
            reach = block.edge[a] * norm
            reach += 1e-9 * (np.abs(low[p]) + np.abs(high[p]) + reach) + 1e-6  # for what rounding takes off
            low[a], high[a] = low[p] - reach, high[p] + reach
            overlap = np.zeros(len(x), bool)
            for b in best[a]:
                # so many candidates lie in the window for sure that the k-th best score is not below this
                sure = low[a, may & (low[a] >= b.low) & (high[a] <= b.high)]
                least = max(b.low, np.partition(sure, -b.k)[-b.k]) if len(sure) >= b.k else b.low
                overlap |= (high[a] >= least) & (low[a] <= b.high)
            at = np.flatnonzero(overlap & may)
            if 2 * len(at) > len(x):  # a matrix read in place costs less than a copy of most of it
                at = everyone
        if not len(at):
            continue
        score = products(x if at is everyone else x[at], block.x[a])
        low[a, at] = high[a, at] = score.astype(float)
        scored += len(at)
        own = np.flatnonzero(may[at])
        found = score[own], vec_id[at[own]], label[at[own]], tie[at[own]]
        for b in best[a]:
            b.add(*found)
    return scored


def search(shared, k: int, same: bool):
    """Scan of packed rows (vec_id, label, tie, dim, q): the best few of every anchor and window of the broadcast blocks,
    at the task's end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = shared.value
        best = [[[Best(k, low, high) for _, low, high in w] for w in b.windows] for b in blocks]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                part = whole.slice(at, ROWS)
                vec_id, label, tie, dim = (part.column(i).to_numpy() for i in range(4))
                vectors = part.column(4).to_pylist()
                for d in np.unique(dim):
                    own = np.flatnonzero(dim == d)
                    x = np.frombuffer(b"".join([vectors[i] for i in own]), "<f8").reshape(len(own), d)
                    for b, found in zip(blocks, best):
                        if b.x.shape[1] == d:
                            some = np.isin(label[own], b.label) if same else np.ones(len(own), bool)
                            to = own[some]
                            if len(to):
                                searched(b, found, x[some], vec_id[to], label[to], tie[to], same)
        rows = [(int(b.number[a]), slot, i, lab, t, -s) for b, found in zip(blocks, best) for a in range(len(b.vec_id))
                for (slot, _, _), f in zip(b.windows[a], found[a]) for s, i, lab, t in f.rows]
        yield from batches_of(rows, [("anchor", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()),
                                     ("label", pa.int64()), ("tie", pa.int64()), ("score", pa.int64())])

    return run


def batches_of(rows: list[tuple], columns: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 10_000):
        cols = list(zip(*rows[at: at + 10_000]))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, columns)],
                                         names=[n for n, _ in columns])


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, is anchor, vector) to (vec_id, label, is anchor, dim, q, code): floor(SCALE * x) as float64, and
    the signs of 16 fixed projections, which similar vectors mostly share."""
    signs: dict[int, np.ndarray] = {}
    for b in batches:
        dims, packed, code = [], [], []
        for v in b.column(3).to_pylist():
            q = np.floor(SCALE * np.array(v, np.float64))
            d = len(q)
            if d not in signs:
                signs[d] = np.random.default_rng(d).standard_normal((d, 16))
            dims.append(d)
            packed.append(q.tobytes())
            code.append(int((q @ signs[d] > 0) @ (1 << np.arange(16))))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(dims, pa.int32()),
                                          pa.array(packed, pa.binary()), pa.array(code, pa.int32())],
                                         names=["vec_id", "label", "is_anchor", "dim", "q", "code"])


def grow(size: int):
    """Scan of sorted anchors (vec_id, label, tie, dim, q): blocks with their trees, in bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def made(own: list[tuple]) -> pa.RecordBatch:
            x = np.frombuffer(b"".join([r[4] for r in own]), "<f8").reshape(len(own), own[0][3])
            order, parent, edge = spanning_tree(x)
            cols = [np.array([r[0] for r in own], np.int64), np.array([r[1] for r in own], np.int64),
                    x.ravel(), order.astype(np.int64), parent.astype(np.int64), edge]
            return pa.RecordBatch.from_arrays(
                [pa.array([len(own)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cols]],
                names=["n", "vec_id", "label", "x", "order", "parent", "edge"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if rows and (len(rows) == size or r[3] != rows[0][3]):
                    yield made(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield made(rows)

    return run


def unpacked(row, first: int) -> Block:
    n = row["n"]
    of = {c: np.frombuffer(row[c], "<i8") for c in ("vec_id", "label", "order", "parent")}
    return Block(first + np.arange(n), of["vec_id"], of["label"], np.frombuffer(row["x"], "<f8").reshape(n, -1),
                 of["order"], of["parent"], np.frombuffer(row["edge"], "<f8"), [[] for _ in range(n)])


def top(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each anchor and slot, with ``rank`` from 1. Tasks give ``k`` at most of each; those of some
    tasks meet first, so that no task gets those of all."""
    order = [F.col("score").desc(), "vec_id", "label", "tie"]
    some = hits.withColumn("part", F.spark_partition_id() % 64)
    first = Window.partitionBy("anchor", "slot", "part").orderBy(*order)
    last = Window.partitionBy("anchor", "slot").orderBy(*order)
    return (some.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).drop("part"))


def prepared(vectors: DataFrame, is_anchor: Column, vec_id: str, vector: str, label: str) -> DataFrame:
    """Rows that take part, once each, dealt evenly to tasks: vec_id, label, tie, dim, q, code, is_anchor."""
    v = F.col(quoted(vector)).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(quoted(vec_id)).isNotNull() & F.col(quoted(label)).isNotNull() & F.col(
        quoted(vector)).isNotNull() & finite).select(
        F.col(quoted(vec_id)).cast("long").alias("vec_id"), F.col(quoted(label)).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), v.alias("v"))
    packed = rows.mapInArrow(pack, "vec_id bigint, label bigint, is_anchor boolean, dim int, q binary, code int")
    spark = vectors.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    once = packed.groupBy("vec_id", "label", "dim", "code", "q").agg(F.max("is_anchor").alias("is_anchor"))
    return checkpointed(once.withColumn("tie", F.xxhash64("q")).repartition(tasks, "vec_id", "tie"))


def waves(blocks: DataFrame, wave_bytes: int) -> list[list[int]]:
    """Numbers of the blocks of each wave."""
    out, size = [], 0
    for r in blocks.select("block", (F.length("x") + F.length("vec_id")).alias("b")).orderBy("block").toLocalIterator():
        if not out or size + r["b"] > wave_bytes:
            out.append([])
            size = 0
        out[-1].append(r["block"])
        size += r["b"]
    return out


def mine(vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (rows that
    ``is_anchor`` holds of) and each of its ``positives`` best rows of the same label, the ``negatives`` best rows of
    other labels with low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = vectors.sparkSession
    rows = prepared(vectors, is_anchor, vec_id, vector, label)
    candidates = rows.select("vec_id", "label", "tie", "dim", "q")
    sort = ["dim", "label", "code", "vec_id", "tie"]
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hard-negatives-{uuid.uuid4().hex}"
    # written with their numbers' ranges, so that a wave reads its own files
    (rows.where("is_anchor").repartitionByRange(*sort).sortWithinPartitions(*sort)
     .select("vec_id", "label", "tie", "dim", "q")
     .mapInArrow(grow(ANCHORS), "n int, vec_id binary, label binary, x binary, `order` binary, parent binary, edge binary")
     .withColumn("block", F.monotonically_increasing_id()).write.parquet(f"{folder}/blocks"))
    blocks, written = spark.read.parquet(f"{folder}/blocks"), False
    for numbers in waves(blocks, wave_bytes):
        got = blocks.where(F.col("block").between(numbers[0], numbers[-1])).orderBy("block").collect()
        wave: list[Block] = []
        for r in got:
            wave.append(unpacked(r, sum(len(b.vec_id) for b in wave)))
            wave[-1].windows = [[(0, -np.inf, np.inf)] for _ in wave[-1].vec_id]
        anchors = [(int(i), b, k) for b in wave for k, i in enumerate(b.vec_id)]
        shared = spark.sparkContext.broadcast(wave)
        # ``positives`` rows at most of each anchor of the wave
        found = top(candidates.mapInArrow(search(shared, positives, True), _HITS), positives).collect()
        for b in wave:
            b.windows = [[] for _ in b.vec_id]
        for r in found:
            _, b, k = anchors[r["anchor"]]
            least, most = -(-low * r["score"] // 100), high * r["score"] // 100
            if least <= most:
                b.windows[k].append((r["rank"], least, most))
        shared = spark.sparkContext.broadcast(wave)
        positive = spark.createDataFrame(
            [(r["anchor"], r["rank"], anchors[r["anchor"]][0], r["vec_id"], r["score"]) for r in found],
            "anchor bigint, slot int, anchor_id bigint, positive_id bigint, positive_score bigint")
        hits = top(candidates.mapInArrow(search(shared, negatives, False), _HITS), negatives)
        hits.join(F.broadcast(positive), ["anchor", "slot"]).select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(f"{folder}/found")
        written = True
    out = checkpointed(spark.read.parquet(f"{folder}/found")) if written else spark.createDataFrame([], _FOUND)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return out

"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

A text becomes ``len(STATISTICS)`` numbers: shares of kinds of characters from a histogram of its bytes, lengths and
repetition of its words, shape and repetition of its lines. Texts are read whole, in NumPy blocks. The trees are grown on
the driver, level by level: statistics are put into ``BINS`` quantile bins, sums of gradients and curvatures of the
logistic loss are gathered by (node, statistic, bin) in one ``bincount``, and each node takes the split of largest gain.
All trees have the same depth and are stored level by level in three arrays (statistic, threshold, leaf value), so all
rows walk down all trees together: child = 2 * node + 1 + (value > threshold).

Learned is a sample of the labelled documents that are not held out, of ``TRAIN_ROWS`` at most: those with the smallest
hashes. The driver gets their statistics, never a text.

Cases: a NULL text is an empty one, whose statistics are all 0, and gets a score like any other; a NULL id is not held
out and has no label; several labels of an id count as their mean, several texts of an id as the one with the smallest
statistics; labels other than 0 and 1 are ignored; without labels every score is one half; with labels of one kind every
score leans to it; columns other than id and text are not read; equal rows get equal rows; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, quoted

TRAIN_ROWS = 20_000
TREES, DEPTH, BINS = 120, 4, 64
RATE, RIDGE, LEAF = 0.1, 1.0, 5.0  # learning rate; L2 penalty of a leaf; least curvature (in rows of even odds, / 4)
FOLDS, OUT = 5, 0
BLOCK_ROWS = 256

# Kinds of bytes, by name; every byte belongs to one kind, the first that names it.
KINDS = {
    "symbol": b"#*$%&|<>", "stop": b".", "pause": b",;:", "shout": b"!?", "quote": b"\"'()[]{}", "slash": b"/\\@_=+~^`-",
    "digit": b"0123456789", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "line": b"\n",
    "space": b" \t\x0b\x0c\r", "multibyte": bytes(range(0xC0, 0x100)), "inside": bytes(range(0x80, 0xC0)),
}
STATISTICS = [f"share_{k}" for k in KINDS] + [
    "share_other", "entropy", "log_chars", "log_words", "word_bytes", "word_bytes_spread", "short_words", "long_words",
    "distinct_words", "commonest_word", "distinct_triples", "capital_words", "marked_words", "wordless", "log_lines",
    "distinct_lines", "line_words", "bullet_lines", "ended_lines", "sentence_words",
]
_KIND = np.full(256, len(KINDS))
for _k, _bytes in reversed(list(enumerate(KINDS.values()))):
    _KIND[list(_bytes)] = _k
_IS_KIND = np.eye(len(KINDS) + 1)[_KIND]  # (byte, kind)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKED = np.zeros(256, bool)  # last bytes of a word that are neither letters, digits nor the marks of a sentence
_MARKED[list(b"#*$%&|<>!?\"'()[]{}/\\@_=+~^`-")] = True


def word_statistics(words: list[bytes]) -> list[float]:
    """Of a text's words, from ``log_words`` to ``wordless``; no Python step a word besides looking it up."""
    n = len(words)
    if not n:
        return [0.0] * 11
    ids, known = pd.factorize(np.array(words, object))
    lengths = np.fromiter(map(len, known), np.int64, len(known))
    first = np.frombuffer(b"".join([w[:1] for w in known]), np.uint8)
    last = np.frombuffer(b"".join([w[-1:] for w in known]), np.uint8)
    times = np.bincount(ids).astype(float)
    mean = (lengths * times).sum() / n
    triples = len(np.unique((ids[:-2] * len(known) + ids[1:-1]) * len(known) + ids[2:])) if n > 2 else n
    return [np.log1p(n), mean, np.sqrt(((lengths - mean) ** 2 * times).sum() / n), times[lengths <= 2].sum() / n,
            times[lengths > 12].sum() / n, len(known) / n, times.max() / n, triples / max(1, n - 2),
            times[_UPPER[first]].sum() / n, times[_MARKED[last]].sum() / n,
            times[~_LETTER[first] & ~_LETTER[last]].sum() / n]


def line_statistics(text: bytes, n_words: int) -> list[float]:
    lines = [x.strip() for x in text.split(b"\n")]
    lines = [x for x in lines if x]
    n = len(lines)
    if not n:
        return [0.0] * 6
    return [np.log1p(n), len(set(lines)) / n, n_words / n, sum(x[:1] in b"-*|#" for x in lines) / n,
            sum(x[-1:] in b".!?" for x in lines) / n, n_words / (1 + text.count(b"."))]


def statistics(texts: list[bytes]) -> np.ndarray:
    """(texts, len(STATISTICS)) numbers; whole texts."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for i, t in enumerate(texts):
        if not t:
            continue
        hist = np.bincount(np.frombuffer(t, np.uint8), minlength=256) / len(t)
        some = hist[hist > 0]
        words = t.split()
        k = len(KINDS) + 1
        out[i, :k] = hist @ _IS_KIND
        out[i, k:] = [-(some * np.log2(some)).sum(), np.log1p(len(t)), *word_statistics(words),
                      *line_statistics(t, len(words))]
    return out


@dataclass
class Trees:
    """Trees of one depth, stored level by level: ``statistic`` and ``threshold`` (trees, 2 ** depth - 1), ``value``
    (trees, 2 ** depth). A node that is not split has an infinite threshold: rows go to its left child."""
    base: float
    statistic: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Scores in 0 to 1."""
        trees, inner = self.statistic.shape
        depth = (inner + 1).bit_length() - 1
        offset, rows = np.arange(trees) * inner, np.arange(len(x))[:, None]
        node = np.zeros((len(x), trees), np.int64)
        statistic, threshold = self.statistic.ravel(), self.threshold.ravel()
        for _ in range(depth):
            at = node + offset
            node = 2 * node + 1 + (x[rows, statistic[at]] > threshold[at])
        leaf = node - inner + np.arange(trees) * (inner + 1)
        return 1 / (1 + np.exp(-(self.base + self.value.ravel()[leaf].sum(1))))


def edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Thresholds between the bins of each statistic: values of the sample, each a bin's largest."""
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins, method="lower")) if len(c) else np.zeros(0) for c in x.T]


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE,
         ridge: float = RIDGE, leaf: float = LEAF) -> Trees:
    """``y`` in 0 to 1."""
    n, m = x.shape
    prior = (y.sum() + 1) / (n + 2)
    base = float(np.log(prior / (1 - prior)))
    inner = 2 ** depth - 1
    model = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                  np.zeros((trees, inner + 1)))
    if not n or y.min() == y.max():
        return model
    cut = edges(x, bins)
    limits = np.full((m, bins), np.inf)
    for j, c in enumerate(cut):
        limits[j, : len(c)] = c
    # bin b holds values above limit b - 1 and up to limit b
    binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cut)], axis=1)
    place = binned + np.arange(m) * bins
    total, all_rows = np.full(n, base), np.arange(n)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            k, low = 2 ** level, 2 ** level - 1
            where = (place + (node - low)[:, None] * (m * bins)).ravel()
            sums = [np.bincount(where, np.repeat(v, m), k * m * bins).reshape(k, m, bins).cumsum(2) for v in (g, h)]
            (gl, hl), (ga, ha) = sums, [s[:, :, -1:] for s in sums]
            gr, hr = ga - gl, ha - hl
            gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - ga ** 2 / (ha + ridge)
            gain = np.where((hl >= leaf / 4) & (hr >= leaf / 4) & np.isfinite(limits), gain, 0).reshape(k, -1)
            best = gain.argmax(1)
            split = gain[np.arange(k), best] > 1e-9
            own = low + np.arange(k)
            model.statistic[t, own] = best // bins
            model.threshold[t, own] = np.where(split, limits.ravel()[best], np.inf)
            j = model.statistic[t, node]
            node = 2 * node + 1 + (x[all_rows, j] > model.threshold[t, node])
        last = node - inner
        value = -rate * np.bincount(last, g, inner + 1) / (np.bincount(last, h, inner + 1) + ridge)
        model.value[t] = value
        total = total + value[last]
    return model


def held_out(doc_id: Column) -> Column:
    """One fifth of the ids, by CRC-32 of the id as text; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == OUT, F.lit(False))


def scan(model: Trees | None):
    """Scan of (doc_id, text) rows: doc_id and the statistics, or the score of a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                b = whole.slice(at, BLOCK_ROWS)
                x = statistics([t or b"" for t in b.column(1).cast(pa.large_binary()).to_pylist()])
                got = (pa.array(list(x), pa.list_(pa.float64())) if model is None else pa.array(model(x)))
                yield pa.RecordBatch.from_arrays([b.column(0), got], names=["doc_id", "score" if model else "x"])

    return run


def sample(labels: DataFrame, doc_id: str, label: str, rows: int) -> DataFrame:
    """(id, y): the ids with the smallest hashes, ``rows`` at most. Counts by the hashes' first 16 bits say how far they
    reach, so that no task sorts all ids."""
    of = F.col(quoted(doc_id))
    known = (labels.where(of.isNotNull() & F.col(quoted(label)).isin(0, 1) & ~held_out(of))
             .groupBy(of.alias("id")).agg(F.avg(quoted(label)).alias("y")).withColumn("k", F.xxhash64("id")))
    known = checkpointed(known)
    high = F.shiftright("k", 48)
    up = Window.orderBy("high").rowsBetween(Window.unboundedPreceding, 0)
    counts = known.groupBy(high.alias("high")).agg(F.count(F.lit(1)).alias("n"))  # 65,536 rows at most
    reach = counts.withColumn("so_far", F.sum("n").over(up)).agg(
        F.coalesce(F.min(F.when(F.col("so_far") >= rows, F.col("high"))), F.max("high")).alias("last")).first()["last"]
    if reach is None:
        return known.select("id", "y")
    return known.where(high <= reach).orderBy("k", "id").limit(rows).select("id", "y")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        rows: int = TRAIN_ROWS) -> Trees:
    """The trees of a bounded sample of the labelled documents that are not held out."""
    some = checkpointed(sample(labels, doc_id, label, rows))  # ``rows`` rows of two numbers at most: broadcast
    own = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    wanted = own.join(F.broadcast(some.select("id")), F.col("doc_id") == F.col("id"), "left_semi")
    id_type = own.schema["doc_id"].dataType.simpleString()
    found = (wanted.mapInArrow(scan(None), f"doc_id {id_type}, x array<double>")
             .groupBy("doc_id").agg(F.min("x").alias("x")))
    got = found.join(some, F.col("doc_id") == F.col("id")).orderBy(F.xxhash64("doc_id"), "doc_id").select("x", "y").collect()
    x = np.array([r.x for r in got], float).reshape(len(got), len(STATISTICS))
    return grow(x, np.array([r.y for r in got], float))


def predict(docs: DataFrame, model: Trees, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score of every row."""
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan(model), f"doc_id {id_type}, score double")

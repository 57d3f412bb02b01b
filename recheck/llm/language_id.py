"""Language of a text: its family first, then one-versus-one linear support vector machines inside the family.

A text becomes hashed counts of its character 1- to 3-grams (letters lower-cased, everything else a blank), square
roots taken, of length 1. Families, and the languages of a family, are told apart by one linear SVM for each pair of
classes; the class with most votes wins, larger margins deciding ties. Texts are read whole, in NumPy blocks.

The SVMs are fitted on the driver by dual coordinate descent to ``SAMPLE_PER_LANG`` labelled texts of each language at
most (those with the smallest hashes), ``SAMPLE_ROWS`` in all, of which it sees the counts: 6 bytes a column that is not
0, never a text. Learned are ``MOST_LANGS`` labels at most, those with most labelled rows (ties: by code point). Families
are ``FAMILIES``; labels that are not listed, and listed families of more than ``FAMILY_LANGS`` labels, are cut into
families of at most so many by their mean features, so that the SVMs are fewer than 1900 (30 MB) whatever the labels.

Cases: a NULL text and one without letters get ``und`` with score 0; with no labelled row every text gets ``und``; with
one language every other text gets that language; NULL labels and NULL ids are never learned from; columns other than
text, and the label while fitting, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recheck.llm import ngrams
from recheck.llm.common import checkpointed, quoted

ORDERS = (1, 2, 3)
DIMS = 1 << 12
SAMPLE_PER_LANG = 250
SAMPLE_ROWS = 5000
MOST_LANGS = 192
FAMILY_LANGS = 12
UND = "und"
# Language families by ISO 639-1 code: fixed values.
FAMILIES = {
    "germanic": "en de nl sv da no is af fy lb".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk sl hr sr bg mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky".split(),
    "indic": "hi bn ur pa gu mr ne si".split(),
    "semitic": "ar he mt am".split(),
}


def family(lang: str) -> str | None:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), None)


def halves(langs: list[str], means: np.ndarray, most: int) -> list[list[str]]:
    """The languages in lists of ``most`` at most, halved along the direction in which their means differ most."""
    if len(langs) <= most:
        return [langs]
    apart = means - means.mean(0)
    order = np.argsort(apart @ np.linalg.svd(apart, full_matrices=False)[2][0], kind="stable")
    parts = [np.sort(order[: len(order) // 2]), np.sort(order[len(order) // 2:])]
    return [part for own in parts for part in halves([langs[i] for i in own], means[own], most)]


def families(x: np.ndarray, langs: list[str], most: int = FAMILY_LANGS) -> list[list[str]]:
    """The languages of ``langs`` by family, of at most ``most`` languages each."""
    known: dict[str, list[str]] = {}
    for lang in sorted(set(langs)):
        known.setdefault(family(lang) or "", []).append(lang)
    of = np.array(langs, object)
    return [part for _, own in sorted(known.items())
            for part in (halves(own, np.stack([x[of == lang].mean(0) for lang in own]), most) if len(own) > most else [own])]


def features(texts: list[str], fold: np.ndarray) -> np.ndarray:
    return ngrams.normalised(hashed(texts, fold))


def hashed(texts: list[str], fold: np.ndarray) -> np.ndarray:
    return ngrams.counts([" " + t for t in texts], ORDERS, DIMS, fold)


def count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, k, text) rows to (lang, k, columns, counts): the counts that are not 0."""
    fold = ngrams.letters_only()
    for whole in batches:
        for at in range(0, whole.num_rows, ngrams.BLOCK_ROWS):
            b = whole.slice(at, ngrams.BLOCK_ROWS)
            found = [(c := np.flatnonzero(x), x[c]) for x in hashed(b.column(2).to_pylist(), fold)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([c.astype("<u2").tobytes() for c, _ in found], pa.binary()),
                 pa.array([n.astype("<f4").tobytes() for _, n in found], pa.binary())],
                names=["lang", "k", "columns", "counts"])


def svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 60) -> np.ndarray:
    """Weights of a linear SVM (squared hinge loss, a constant column as its bias), y in {-1, 1}."""
    n = len(y)
    inner = x @ x.T  # at most SAMPLE_ROWS x SAMPLE_ROWS
    q, a, margin = inner.diagonal() + 0.5 / cost, np.zeros(n), np.zeros(n)
    order = np.random.default_rng(0)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(n).tolist():
            g = y[i] * margin[i] - 1 + 0.5 / cost * a[i]
            if a[i] == 0 and g >= 0:
                continue
            new = max(a[i] - g / q[i], 0.0)
            margin += ((new - a[i]) * y[i]) * inner[i]
            most = max(most, abs(g))
            a[i] = new
        if most < 1e-3:
            break
    return (a * y) @ x


class Votes:
    """One SVM for each pair of classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray, classes: list[str]):
        self.classes, self.pairs = classes, list(combinations(range(len(classes)), 2))
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
        cols = []
        for a, b in self.pairs:
            own = (y == a) | (y == b)
            cols.append(svm(x[own].astype(float), np.where(y[own] == a, 1.0, -1.0)))
        self.w = np.array(cols, np.float32).reshape(len(cols), x.shape[1])

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, score in 0 to 1) of each row: the mean over the winner's pairs of its squashed margin."""
        k = len(self.classes)
        if k == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        margin = x @ self.w[:, :-1].T + self.w[:, -1]
        votes, soft = np.zeros((len(x), k)), np.zeros((len(x), k))
        p = 1 / (1 + np.exp(-4.0 * margin.astype(float)))
        for j, (a, b) in enumerate(self.pairs):
            votes[:, a] += margin[:, j] >= 0
            votes[:, b] += margin[:, j] < 0
            soft[:, a] += p[:, j]
            soft[:, b] += 1 - p[:, j]
        best = np.argmax(votes + soft / (k + 1), axis=1)
        return best, soft[np.arange(len(x)), best] / (k - 1)


class Model:
    """Families, then languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        """``x``: the features of one text of each of ``langs``."""
        self.fold = ngrams.letters_only()
        self.families = families(x, langs)
        of = {lang: k for k, own in enumerate(self.families) for lang in own}
        fam = np.array([of[lang] for lang in langs], int)
        self.top = Votes(x, fam, [" ".join(own) for own in self.families]) if langs else None
        self.inner = []
        for k, own in enumerate(self.families):
            rows = np.flatnonzero(fam == k)
            self.inner.append(Votes(x[rows], np.array([own.index(langs[i]) for i in rows]), own))

    def __call__(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        out, score = [UND] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.top else []
        for at in range(0, len(known), ngrams.BLOCK_ROWS):
            rows = np.array(known[at: at + ngrams.BLOCK_ROWS])
            x = features([texts[i] for i in rows], self.fold)
            fam, s = self.top(x)
            for k, inner in enumerate(self.inner):
                own = np.flatnonzero(fam == k)
                if len(own):
                    best, inside = inner(x[own])
                    score[rows[own]] = s[own] * inside
                    for i, b in zip(rows[own], best):
                        out[i] = inner.classes[b]
        return out, np.clip(score, 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """One third of the ids, by CRC-32 of the id as text; false for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = SAMPLE_PER_LANG, most: int = MOST_LANGS) -> Model:
    """The model of a bounded sample of the rows with a label and an id that are not held out."""
    labelled = docs.where(F.col(quoted(lang)).isNotNull() & F.col(quoted(doc_id)).isNotNull()
                          & ~held_out(F.col(quoted(doc_id))))
    langs = [r.lang for r in labelled.groupBy(F.col(quoted(lang)).alias("lang")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(most).collect()]
    per_lang = max(1, min(per_lang, SAMPLE_ROWS // max(1, len(langs))))
    own = labelled.where(F.col(quoted(text)).isNotNull() & F.col(quoted(lang)).isin(langs))
    keyed = own.select(F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"),
                       F.xxhash64(quoted(doc_id), quoted(lang)).alias("k"))
    # The least hashes of each language: counts by the hashes' first 12 bits say how far they reach, so that one task
    # sees a 4096th of a language at most besides the sample; then the texts that have them.
    keys, high = keyed.select("lang", "k").distinct(), F.shiftright("k", 52)
    up = Window.partitionBy("lang").orderBy("high").rowsBetween(Window.unboundedPreceding, 0)
    reach = (keys.groupBy("lang", high.alias("high")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("so_far", F.sum("n").over(up)).groupBy(F.col("lang").alias("l0")).agg(
                 F.coalesce(F.min(F.when(F.col("so_far") >= per_lang, F.col("high"))), F.max("high")).alias("last")))
    first = Window.partitionBy("lang").orderBy("k")
    least = checkpointed(keys.join(F.broadcast(reach), F.col("lang") == F.col("l0")).where(high <= F.col("last"))
                         .withColumn("at", F.row_number().over(first)).where(F.col("at") <= per_lang)
                         .select(F.col("lang").alias("l2"), F.col("k").alias("k2")))
    rows = (keyed.join(F.broadcast(least), (F.col("lang") == F.col("l2")) & (F.col("k") == F.col("k2")))
            .groupBy("lang", "k").agg(F.min("text").cast("string").alias("text"))
            .mapInArrow(count_texts, f"lang {keyed.schema['lang'].dataType.simpleString()}, k bigint, columns binary, "
                                     "counts binary").orderBy("lang", "k").select("lang", "columns", "counts").collect())
    x = np.zeros((len(rows), DIMS), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["columns"], "<u2")] = np.frombuffer(r["counts"], "<f4")
    return Model(ngrams.normalised(x), [r.lang for r in rows])


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    kind = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, score = shared.value(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(score)],
                                             names=["doc_id", "lang_pred", "score"])

    id_type = kind.schema["doc_id"].dataType.simpleString()
    return kind.mapInArrow(scan, f"doc_id {id_type}, lang_pred string, score double")

"""Quality classifier: trees against plain loops, held-out accuracy, the sample's bound, odd inputs."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recheck.llm import quality_model as Q

GOOD = "the and of to in that with for you this which from they have river stone letter garden".split()


def corpus(n, seed=3):
    """(doc_id, text, lang, source), label: prose, or prose spoilt in one of four ways."""
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [rnd.choice(GOOD) + rnd.choice(["", "s", "ed", "ing"]) for _ in range(rnd.randint(20, 90))]
        good = rnd.random() < 0.7
        if good:
            text = " ".join(w + ("." if k % 9 == 8 else "") for k, w in enumerate(words))
        else:
            text = rnd.choice([lambda: " | ".join(words), lambda: " ".join(words).upper() + "!!",
                               lambda: " ".join(words[:3] * 20), lambda: "\n".join(f"{w} $$$" for w in words)])()
        rows.append((i, text, "en", "s"))
        labels.append((i, int(good), 0))
    return rows, labels


def frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def out_of(ids):
    return {i for i in ids if i is not None and zlib.crc32(str(i).encode()) % 5 == 0}


def test_held_out_accuracy(spark, docs_frame):
    rows, labels = corpus(500)
    docs = docs_frame(rows)
    model = Q.fit(docs, frame(spark, labels))
    got = {r.doc_id: r.score for r in Q.predict(docs, model).collect()}
    out = out_of(got)
    marked = {r.doc_id for r in docs.where(Q.held_out(F.col("doc_id"))).collect()}
    assert marked == out and 60 < len(out) < 140
    assert np.mean([(got[i] >= 0.3) == y for i, y, _ in labels if i in out]) > 0.95
    assert all(0 <= s <= 1 for s in got.values())


def test_held_out_labels_and_other_columns_are_not_read(spark, docs_frame):
    rows, labels = corpus(200)
    out = out_of(range(200))
    turned = [(i, 1 - y if i in out else y, 1 - t) for i, y, t in labels]
    a = Q.fit(docs_frame(rows), frame(spark, labels))
    b = Q.fit(docs_frame([(i, t, "xx", "other") for i, t, *_ in rows]), frame(spark, turned))
    for x, y in ((a.statistic, b.statistic), (a.threshold, b.threshold), (a.value, b.value)):
        assert (x == y).all()


def slow_score(model, row):
    """Down each tree, one node after the other."""
    total = model.base
    inner = model.statistic.shape[1]
    for s, t, v in zip(model.statistic, model.threshold, model.value):
        node = 0
        while node < inner:
            node = 2 * node + (2 if row[s[node]] > t[node] else 1)
        total += v[node - inner]
    return 1 / (1 + np.exp(-total))


def test_traversal_equals_a_walk():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, (300, 5)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 3] > 2)).astype(float)
    model = Q.grow(x, y, trees=20, depth=3, bins=8)
    got = model(x)
    assert np.allclose(got, [slow_score(model, r) for r in x])
    assert ((got > 0.5) == y).mean() > 0.98
    assert np.isfinite(model.threshold).any() and np.isinf(model(np.zeros((0, 5)))).sum() == 0


def test_first_split_equals_all_splits_tried():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 6, (200, 4)).astype(float)
    y = (x[:, 2] + rng.normal(0, 1, 200) > 3).astype(float)
    model = Q.grow(x, y, trees=1, depth=1, bins=16, leaf=0.0)
    p = (y.sum() + 1) / (len(y) + 2)
    g, h = p - y, np.full(len(y), p * (1 - p))

    def gain(rows):
        return g[rows].sum() ** 2 / (h[rows].sum() + Q.RIDGE)

    tried = {(j, t): gain(x[:, j] <= t) + gain(x[:, j] > t) for j in range(4) for t in np.unique(x[:, j])[:-1]}
    best = max(tried.values())
    assert tried[int(model.statistic[0, 0]), model.threshold[0, 0]] == pytest.approx(best)
    left = x[:, model.statistic[0, 0]] <= model.threshold[0, 0]
    for side, rows in ((0, left), (1, ~left)):
        assert model.value[0, side] == pytest.approx(-Q.RATE * g[rows].sum() / (h[rows].sum() + Q.RIDGE))


def test_statistics_of_known_texts():
    of = lambda t: dict(zip(Q.STATISTICS, Q.statistics([t.encode()])[0]))
    a = of("Ab ab ab.\nAb ab ab.\n- x 你")
    assert a["log_words"] == pytest.approx(np.log(10)) and a["log_lines"] == pytest.approx(np.log(4))
    assert a["distinct_lines"] == pytest.approx(2 / 3) and a["bullet_lines"] == pytest.approx(1 / 3)
    assert a["ended_lines"] == pytest.approx(2 / 3) and a["capital_words"] == pytest.approx(2 / 9)
    assert a["distinct_words"] == pytest.approx(6 / 9) and a["commonest_word"] == pytest.approx(2 / 9)
    assert a["distinct_triples"] == pytest.approx(6 / 7)
    assert sum(v for k, v in a.items() if k.startswith("share_")) == pytest.approx(1)
    assert not Q.statistics([b""]).any() and np.isfinite(Q.statistics([b" \n", b"\x00", b"w" * 10**6])).all()


def test_the_sample_is_bounded(spark, docs_frame, monkeypatch):
    rows, labels = corpus(300)
    seen = []
    real = Q.grow
    monkeypatch.setattr(Q, "grow", lambda x, y: seen.append((x, y)) or real(x, y))
    Q.fit(docs_frame(rows + rows[:40] * 3), frame(spark, labels * 2), rows=50)
    assert seen[0][0].shape == (50, len(Q.STATISTICS))
    Q.fit(docs_frame(rows), frame(spark, labels), rows=10_000)
    assert len(seen[1][1]) == 300 - len(out_of(range(300)))


def test_odd_inputs(spark, docs_frame, weird, weird_rows, empty):
    labels = [(i, k % 2, None) for k, (i, *_) in enumerate(weird_rows)] + [(None, 1, 1), (3, None, 0), (4, 7, 0),
                                                                           (5, 0, 0), (5, 1, 0), (10**9, 1, 0)]
    model = Q.fit(weird, frame(spark, labels))
    got = Q.predict(weird, model).collect()
    assert len(got) == len(weird_rows) and all(0 <= r.score <= 1 for r in got)
    same = {}
    for r, t in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)),
                    sorted(weird_rows, key=lambda r: (r[0] is None, r[0] or 0))):
        same.setdefault(t[1] or "", set())
    assert model(Q.statistics([b""]))[0] in {r.score for r in got if r.doc_id in (68, 69)}
    assert Q.predict(empty, model).count() == 0
    nothing = Q.fit(empty, frame(spark, []))
    assert {r.score for r in Q.predict(weird, nothing).collect()} == {0.5}
    assert Q.fit(weird, frame(spark, [])).base == 0.0
    ones = Q.fit(weird, frame(spark, [(i, 1, 0) for i in range(30)]))
    assert {r.score > 0.9 for r in Q.predict(weird, ones).collect()} == {True}

"""Language identification and the URL filter: fixed cases and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recheck.llm import language_id, ngrams, url_filter

WORDS = {"en": "the and of to in that with for you this which from they have".split(),
         "de": "der die und das nicht mit sich auf für ist eine werden schon über".split(),
         "fr": "le la les des une est dans que pour qui sur avec était être".split(),
         "es": "el los las una que por con para está pero más como año también".split()}


def sentences(n, seed=1):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(6, 30))), lang, "s")
            for i in range(n) for lang in [rnd.choice(list(WORDS))]]


def test_held_out_accuracy(docs_frame):
    rows = sentences(400)
    docs = docs_frame(rows)
    model = language_id.fit(docs)
    got = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    out = {r.doc_id for r in docs.where(language_id.held_out(F.col("doc_id"))).collect()}
    assert 90 < len(out) < 180
    assert np.mean([got[i].lang_pred == lang for i, _, lang, _ in rows if i in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_do_not_reach_predictions(docs_frame):
    rows = sentences(200)
    docs = docs_frame(rows)
    model = language_id.fit(docs)
    twisted = docs_frame([(i + 1000, t, "xx", "other") for i, t, _, _ in rows])
    a = [(r.lang_pred, r.score) for r in language_id.predict(docs, model).orderBy("doc_id").collect()]
    b = [(r.lang_pred, r.score) for r in language_id.predict(twisted, model).orderBy("doc_id").collect()]
    assert a == b


def test_language_cases(weird, weird_rows, empty, docs_frame):
    docs = weird
    model = language_id.fit(docs)
    got = language_id.predict(docs, model).collect()
    assert len(got) == len(weird_rows)
    by_id = {r.doc_id: r for r in got}
    n = 60
    for i in (n + 8, n + 9, n + 10, n + 15):  # NULL, empty, blank, no letter
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert {r.lang_pred for r in got} <= {"und", "en", "de", "fr", "es"}
    nothing = language_id.fit(empty)
    assert {r.lang_pred for r in language_id.predict(docs, nothing).collect()} == {"und"}
    assert language_id.predict(empty, model).count() == 0
    one = language_id.fit(docs_frame([(i, "some text", "en", "s") for i in range(9)]))
    assert language_id.predict(docs, one).where("lang_pred = 'en'").count() > 50


def test_sample_is_bounded(docs_frame):
    docs = docs_frame([(i, "one two three" if i % 2 else "eins zwei drei", "en" if i % 2 else "de", "s") for i in range(300)]
                      + [(1, "one two three", "en", "s")] * 50)
    seen = []
    real = language_id.Model
    language_id.Model = lambda texts, langs: seen.append(langs) or real(texts, langs)
    try:
        language_id.fit(docs, per_lang=20)
    finally:
        language_id.Model = real
    assert seen[0].count("en") == 20 and seen[0].count("de") == 20


def test_labels_are_bounded(docs_frame):
    """2000 labels, those of one listed family among them: as many are learned as allowed, in small families."""
    rnd = random.Random(3)
    names = [f"x{i}" for i in range(1900)] + [f"en-{i}" for i in range(100)]
    docs = docs_frame([(i, " ".join(f"{name}{rnd.choice('abcd')}" for _ in range(9)), name, "s")
                       for i, name in enumerate(names * 2)] + [(9000 + i, "der die das und nicht", "de", "s") for i in range(90)])
    model = language_id.fit(docs, most=60)
    learned = sorted(lang for own in model.families for lang in own)
    assert len(learned) == len(set(learned)) == 60 and "de" in learned
    assert max(map(len, model.families)) <= language_id.FAMILY_LANGS
    assert {r.lang_pred for r in language_id.predict(docs, model).where("doc_id >= 9000").collect()} == {"de"}


def test_svm_count_is_bounded():
    """At the largest number of labels; every label is in one family, and listed families stay together if small."""
    rnd = np.random.default_rng(0)
    langs = sorted(["en", "de", "nl", "fr", "es", *(f"q{i}" for i in range(language_id.MOST_LANGS - 5))])
    x = rnd.random((len(langs), 64), np.float32)
    found = language_id.families(x, langs)
    assert sorted(lang for own in found for lang in own) == langs
    assert ["de", "en", "nl"] in found and ["es", "fr"] in found
    pairs = len(found) * (len(found) - 1) // 2 + sum(len(own) * (len(own) - 1) // 2 for own in found)
    assert max(map(len, found)) <= language_id.FAMILY_LANGS and pairs < 1900


def test_ngram_counts_equal_a_plain_loop(monkeypatch):
    texts = ["abc abd", "", "é" * 40 + "x\0y", "z" * 90, "ab"]
    monkeypatch.setattr(ngrams, "BLOCK_CHARS", 16)  # long texts come in overlapping pieces
    small = ngrams.counts(texts, (1, 2, 3), 256)
    monkeypatch.setattr(ngrams, "BLOCK_CHARS", 1 << 19)
    assert (small == ngrams.counts(texts, (1, 2, 3), 256)).all()
    assert [int(x) for x in small.sum(1)] == [sum(max(0, len(t) + 1 - n + 1) for n in (1, 2, 3)) for t in texts]
    same = ngrams.counts(["xaby", "ab"], (2,), 4096)
    assert (same[0] * same[1]).sum() >= 1  # "ab" has one column wherever it stands


def test_url_rules(spark):
    cases = {
        "https://a.com/x": ("com/", "allow"), "https://a.com": (None, None), "HTTP://WWW.Example.COM/en/1?q": (
            "www.example.com/en/", "allow"), "http://m.example.com/en/": ("example.com/en/", "block"),
        "http://example.com/EN/": ("com/", "allow"), "http://notexample.com/en/": ("com/", "allow"),
        "http://b.www.example.com/en/": ("www.example.com/en/", "allow"), "x://net/es/1": ("net/es/", "block"),
        "x://y.net/fr/": ("net/fr/", "block"), "x://y.net/de/": (None, None), "x://telnet/fr/": (None, None),
        "example.com/en/": (None, None), "": (None, None), "x://com/a://b.net/es/": ("com/", "allow"),
        "x://h.com?/en/": (None, None), "x://h.com#/en/": (None, None), "://a.com/": ("com/", "allow")}
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(cases)] + [(99, None)], "page_id bigint, url string")
    got = {r.url: r for r in url_filter.judge(pages).collect()}
    for u, (rule, verdict) in cases.items():
        assert got[u].rule == rule, u
        assert got[u].verdict in ("allow", "block") and (verdict is None or got[u].verdict == verdict)
    assert (got[None].host, got[None].path, got[None].rule, got[None].verdict) == ("", "", None, "allow")
    assert (got["x://com/a://b.net/es/"].host, got["x://com/a://b.net/es/"].path) == ("com", "/a://b.net/es/")
    assert (got["HTTP://WWW.Example.COM/en/1?q"].host, got["HTTP://WWW.Example.COM/en/1?q"].path) == (
        "www.example.com", "/en/1")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_regression_held_out():
    rows = url_filter.labelled_urls()
    host = [u.split("://")[1].split("/")[0] for u, _ in rows]
    path = ["/" + u.split("://")[1].split("/", 1)[1].split("?")[0] for u, _ in rows]
    y = np.array([v for _, v in rows], float)
    name = np.arange(len(rows)) // 2  # both URLs of a name are held out together
    x, right = url_filter.features(host, path), []
    for f in range(5):
        w = url_filter.fit(x[name % 5 != f], y[name % 5 != f])
        right += list(((x[name % 5 == f] @ w) > 0) == y[name % 5 == f])
    assert np.mean(right) > 0.8
    assert (((x @ url_filter.fit(x, y)) > 0) == y).all()
    assert not url_filter.fit(x[:0], y[:0]).any() and (x[:3] @ url_filter.fit(x[:3], np.ones(3)) > 0).all()


@pytest.mark.parametrize("label, verdict", [(1, "block"), (0, "allow")])
def test_url_labels_of_one_class(spark, label, verdict):
    labelled = spark.createDataFrame([("http://a.org/x", label), (None, label)], "url string, label int")
    pages = spark.createDataFrame([(1, "http://b.org/y")], "page_id bigint, url string")
    assert url_filter.judge(pages, labelled=labelled).first().verdict == verdict


def test_the_driver_gets_counts_of_the_sample(docs_frame, monkeypatch):
    """A fixed number of bytes at most for each sampled text, and the features of the whole texts."""
    import pyspark.sql.classic.dataframe as frames
    rows = sentences(60)
    rows[3] = (3, " ".join(chr(0x4E00 + i % 9000) for i in range(150000)), "zh", "s")
    rows = [r for r in rows if r[0] % 7]
    seen, most, collect = [], [], frames.DataFrame.collect

    def spy(df):
        got = collect(df)
        most.extend(len(v.encode()) if isinstance(v, str) else len(v)
                    for r in got for v in r if isinstance(v, (str, bytes, bytearray)))
        return got

    real = language_id.Model
    monkeypatch.setattr(frames.DataFrame, "collect", spy)
    monkeypatch.setattr(language_id, "Model", lambda x, langs: seen.append((x, langs)) or real(x, langs))
    docs = docs_frame(rows)
    out = {r.doc_id for r in docs.where(language_id.held_out(F.col("doc_id"))).select("doc_id").collect()}
    most.clear()
    language_id.fit(docs)
    assert most and max(most) <= 4 * language_id.DIMS
    [(x, langs)] = seen
    want = language_id.features([t for i, t, *_ in rows if i not in out], ngrams.letters_only())
    assert sorted(map(bytes, x)) == sorted(map(bytes, want)) and len(langs) == len(want)

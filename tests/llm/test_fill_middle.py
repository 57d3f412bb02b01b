"""Fill-in-the-middle: the index of exceptions, cuts and outputs against plain Python, the round trip."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recheck.llm import fill_middle as M

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def slow(doc_id, text, plain=50, spm=80):
    """(n, form, prefix_chars, middle_chars, output) by the pattern and slices of the text."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k: 8 * k + 8], 16) for k in range(4)]
    u = TOKEN.findall(text)
    n = len(u)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= plain:
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b\x1cé½你😀߿<P>SM", max_size=30), max_size=8), st.integers(0, 10**6))
def test_blocks_equal_the_pattern(texts, seed):
    h = [np.array([random.Random(seed + 9 * i + k).getrandbits(32) for i in range(len(texts))], np.int64) for k in range(4)]
    rows = []
    for _, n, forms, prefix, middle, outputs in M.rearranged(pa.array(texts, pa.string()), h, 70, 50):
        rows += zip(n.tolist(), forms.to_pylist(), prefix.to_pylist(), middle.to_pylist(), outputs.to_pylist())
    assert len(rows) == len(texts)
    for i, (t, (n, form, p, m, out)) in enumerate(zip(texts, rows)):
        u = TOKEN.findall(t)
        a, b = sorted((int(h[0][i]) % (len(u) + 1), int(h[1][i]) % (len(u) + 1)))
        assert n == len(u)
        if form != "plain":
            parts = ["".join(u[:a]), "".join(u[a:b]), "".join(u[b:])]
            assert (p, m) == (len(parts[0]), len(parts[1]))
            assert out == M.joined(form, *[x.encode() for x in parts])
        else:
            assert out.decode() == t and p is None and m is None
        assert (form == "plain") == (not t or bool(re.search("<[PSM]>", t)) or int(h[2][i]) % 100 >= 70)


@given(st.text(alphabet="aé你😀 ", max_size=60))
def test_exceptions_convert_both_ways(text):
    data = np.frombuffer(text.encode(), np.uint8)
    index = M.Exceptions(data)
    places = np.array([len(text[:k].encode()) for k in range(len(text) + 1)])
    assert index.chars(places).tolist() == list(range(len(text) + 1))
    assert index.bytes(np.arange(len(text) + 1)).tolist() == places.tolist()
    assert len(index.at) == sum(ord(c) > 127 for c in text)  # ASCII records nothing


def test_small_blocks_change_nothing(monkeypatch):
    texts = pa.array(["a b c", None, "", "é " * 50, "x", "  ", "你好 ab\n"] * 9)
    h = [np.arange(63) * 7 + k for k in range(4)]
    whole = [M.rearranged(texts, h), M.rearranged(texts.slice(0, 63), h)]
    want = [r[5].to_pylist() for r in whole[0]]
    monkeypatch.setattr(M, "BLOCK_BYTES", 20)
    got = [r[5].to_pylist() for r in M.rearranged(texts, h)]
    assert len(got) > 9 and sum(got, []) == sum(want, [])
    part = [r[5].to_pylist() for r in M.rearranged(texts.slice(5, 20), [x[5:25] for x in h])]
    assert sum(part, []) == sum(want, [])[5:25]


@pytest.mark.parametrize("plain, spm", [(50, 80), (100, 0), (100, 100)])
def test_documents_equal_plain_python_and_come_back(weird, weird_rows, empty, plain, spm):
    out = M.transform(weird, plain_percent=plain, spm_percent=spm)
    rows = out.withColumn("again", M.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: tuple((v is None, v) for v in r)
    want = sorted(((i, *slow(i, t, plain, spm), t or "") for i, t, *_ in weird_rows), key=key)
    assert sorted((tuple(r) for r in rows), key=key) == want
    assert {r.form for r in rows} >= ({"plain", "psm", "spm"} if plain == 50 else {"plain", "psm" if spm == 0 else "spm"})
    assert M.transform(empty).count() == 0 and M.transform(empty).columns == out.columns


def test_marks_at_seams(spark):
    """Parts that end or begin with pieces of marks."""
    texts = ["<P >S> x", "< <S M>", "a<P", "<S", "P> <M >", "<<< >>>", "<P> in it", "x<M>"]
    docs = spark.createDataFrame([(k, t) for k in range(40) for t in texts], "doc_id bigint, text string")
    out = M.transform(docs, plain_percent=100)
    rows = out.select("doc_id", "form", M.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert sorted((r.doc_id, r.t) for r in rows) == sorted((k, t) for k in range(40) for t in texts)
    assert sum(r.form == "plain" for r in rows) == 80

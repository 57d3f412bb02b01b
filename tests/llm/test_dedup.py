"""Exact dedup, SimHash near-dedup and substring dedup against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from recheck.llm import exact_dedup, simhash, substring_dedup
from recheck.llm.shingle_hashes import Hashes, anchors


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def before(i):
    return -1 if i is None else i


def test_exact_groups(weird, weird_rows, empty):
    got = exact_dedup.groups(weird).collect()
    groups = defaultdict(list)
    for i, t, *_ in weird_rows:
        groups[lowered(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max(ids, key=before)
        d = hashlib.sha256(t.encode()).digest()
        for i in ids:
            want[(i, keep, len(ids), d)] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in got) == want
    kept = [(r.doc_id, bytes(r.digest)) for r in got if r.kept]
    assert Counter(d for _, d in kept) == Counter({hashlib.sha256(t.encode()).digest(): 1 for t in groups})
    assert all(i == max(groups[t], key=before) for t in groups for i, d in kept
               if d == hashlib.sha256(t.encode()).digest())
    assert exact_dedup.groups(empty).count() == 0


def test_exact_dedup_keeps_rows_whole(weird, weird_rows, empty):
    out = exact_dedup.dedup(weird)
    assert out.columns == weird.columns
    groups = defaultdict(list)
    for i, t, *_ in weird_rows:
        groups[lowered(t)].append(i)
    assert sorted((r.doc_id for r in out.collect()), key=before) == sorted(
        (max(g, key=before) for g in groups.values()), key=before)
    assert exact_dedup.dedup(empty).count() == 0


def test_exact_hot_group(spark, docs_frame):
    rows = [(i, "the same Text" if i % 3 else f"text {i}", "en", "s") for i in range(3000)]
    got = exact_dedup.groups(docs_frame(rows)).collect()
    hot = [r for r in got if r.group_size == 2000]
    assert len(got) == 3000 and len(hot) == 2000 and {r.keep_id for r in hot} == {2999}
    assert sum(r.kept for r in got) == 1001


def test_misra_gries_bound():
    rng = np.random.default_rng(1)
    data = [f"h{i % 3}" if rng.random() < 0.5 else f"r{rng.integers(4000)}" for i in range(6000)]
    k, seen = 50, Counter()
    for at in range(0, len(data), 500):
        seen = exact_dedup.misra_gries(seen, Counter(data[at: at + 500]), k)
        assert len(seen) <= k
    full = Counter(data)
    assert all(full[d] - len(data) / (k + 1) <= seen[d] <= full[d] for d in ("h0", "h1", "h2"))


def slow_fingerprint(text):
    words = lowered(text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_labels(fps, bits=4):
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= bits
    label = np.arange(len(x))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(x))])
        if (new == label).all():
            return label
        label = new


def test_simhash_components(weird, weird_rows, empty):
    for node_rows in (simhash.NODE_ROWS, 4):  # the second walks nodes down in Spark
        got = Counter((r.doc_id, r.fp % 2**64, r.component_id)
                      for r in simhash.components(weird, node_rows=node_rows).collect())
        fps = [slow_fingerprint(t) for _, t, *_ in weird_rows]
        label = slow_labels(fps)
        least = {}
        for (i, *_), c in zip(weird_rows, label):
            if i is not None:
                least[c] = min(i, least.get(c, i))
        assert got == Counter((i, f, least.get(c)) for (i, *_), f, c in zip(weird_rows, fps, label))
    assert simhash.components(empty).count() == 0


def test_simhash_dedup(weird, weird_rows, empty):
    out = simhash.dedup(weird)
    assert out.columns == weird.columns
    label = slow_labels([slow_fingerprint(t) for _, t, *_ in weird_rows])
    want = []
    for c in set(label.tolist()):
        ids = [i for (i, *_), x in zip(weird_rows, label) if x == c]
        want.append(min(ids, key=lambda i: (i is None, i)))
    assert sorted((r.doc_id for r in out.collect()), key=before) == sorted(want, key=before)
    assert simhash.dedup(empty).count() == 0


def test_walk_finds_all_links():
    rng = np.random.default_rng(5)
    for spread in (0, 3, 8):
        base = rng.integers(0, 2**63, 12, dtype=np.uint64)
        xs = []
        for _ in range(250):
            v = int(base[rng.integers(len(base))])
            for b in rng.choice(64, rng.integers(0, spread + 1), replace=False):
                v ^= 1 << int(b)
            xs.append(v)
        x = np.unique(np.array(xs, np.uint64))
        root = simhash.walk(x, np.array([[0, len(x), 0, len(x), 0]]), 0, 4)
        assert (root == slow_labels(x)).all()


def test_chain_becomes_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a bigint, b bigint")
    got = {r.node: r.label for r in simhash.connected(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[1001] == 1000


def slow_substrings(rows, window=50):
    first = {}
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        for p in range(len(words) - window + 1):
            k = b" ".join(words[p: p + window])
            if i is not None:
                first[k] = min(i, first.get(k, i))
    out = Counter()
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if i is not None and first[b" ".join(words[p: p + window])] < i:
                gone[p: p + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[(i, len(words), sum(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_substrings(weird, weird_rows, empty):
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup(weird).collect())
    want = slow_substrings(weird_rows)
    assert got == want and sum(k[2] for k in want.elements()) > 400
    assert substring_dedup.dedup(empty).count() == 0


def test_substrings_of_few_words(docs_frame):
    """Random texts of two and three words: anchors, edges and windows repeat in every way they can."""
    rng = np.random.default_rng(2)
    base = [" ".join(rng.choice(["a", "b", "c"][: 2 + k % 2], 160)) for k in range(4)]
    rows = []
    for i in range(24):
        t = base[i % 4].split()
        at = int(rng.integers(0, 90))
        rows.append((i, " ".join(list(rng.choice(["a", "b"], 20)) + t[at: at + 70] + list(rng.choice(["a", "c"], 20))), "en", "s"))
    rows.append((40, "a " * 200, "en", "s"))
    rows.append((41, "a " * 120, "en", "s"))
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                  for r in substring_dedup.dedup(docs_frame(rows)).collect())
    assert got == slow_substrings(rows)


def test_every_window_has_an_anchor():
    rng = np.random.default_rng(3)
    for words in (["a", "b"], [f"w{i}" for i in range(500)]):
        text = [w.encode() for w in rng.choice(words, 1000)]
        pos, _ = anchors(Hashes(text), substring_dedup.K, 50)
        starts = np.concatenate([[-1], pos, [1000 - substring_dedup.K + 1]])
        assert np.diff(starts).max() <= 50 - substring_dedup.K + 1

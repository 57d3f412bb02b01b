"""Hot n x m keys: the distributed path equals the plain loop, whatever the limits; work spread; the guard."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import test_match
from recheck.operators import hot_keys as H
from recheck.operators.match import HOT, HotKeyError, reconcile
from test_match import COLS, as_dicts, naive, rows, run, typed_rows


@pytest.mark.parametrize("group, block, short, index_bytes", [(4096, 4096, 512, 256 << 20), (3, 4, 512, 1), (5, 7, 2, 1)])
@pytest.mark.parametrize("consume_exact", [True, False])
def test_every_limit_equals_naive(spark, monkeypatch, group, block, short, index_bytes, consume_exact):
    """Tiny groups, blocks, lists (rows left over are then scanned) and indexes change nothing."""
    for name, v in (("BLOCK", block), ("LISTED", index_bytes)):
        monkeypatch.setattr(H, name, v)
    lists, resolve = H.short_lists, H.resolve
    monkeypatch.setattr(H, "short_lists", lambda a, b, c: lists(a, b, c, group, short))
    monkeypatch.setattr(H, "resolve", lambda a, b, c, e: resolve(a, b, c, e, index_bytes))
    rng = random.Random(group)
    left, right = rows(rng, 70, 0), rows(rng, 60, 1000)
    assert run(spark, left, right, hot_pairs=0, consume_exact=consume_exact) == naive(left, right, consume_exact)
    assert run(spark, left, right, hot_pairs=0, fast_paths=False) == naive(left, right)


def test_every_type(spark, monkeypatch):
    rng = random.Random(4)
    left, right = typed_rows(rng, 50, 0, [1, 2, 3]), typed_rows(rng, 60, 1000, [1, 2, 4])
    monkeypatch.setattr(test_match, "COLS", test_match.TCOLS)
    res = reconcile(spark.createDataFrame(left, test_match.TYPED), spark.createDataFrame(right, test_match.TYPED), "k",
                    test_match.TCOLS, order_by=["o"], row_id="id", hot_pairs=0)
    got = {r.row_id: (r.matched_id, r.consumed_id, ",".join(r.diff_columns)) for r in res.pairs.collect()}
    assert got == naive(as_dicts(left), as_dicts(right))[0]


def table(spark, n, id0, seed, values):
    rng = np.random.default_rng(seed)
    return spark.createDataFrame([(id0 + i, "hot" if rng.random() < 0.9 else "warm", int(rng.integers(0, 9)),
                                   *[str(v) for v in rng.integers(0, values, 6)]) for i in range(n)],
                                 "id long, k string, o long, " + ", ".join(f"c{j} string" for j in range(6)))


@pytest.mark.parametrize("values", [4, 300])
def test_hot_equals_the_streamed_matcher(spark, values):
    left, right = table(spark, 1500, 0, 1, values), table(spark, 1300, 10_000, 2, values)
    cols = [f"c{j}" for j in range(6)]

    def out(hot_pairs):
        res = reconcile(left, right, "k", cols, order_by=["o"], row_id="id", hot_pairs=hot_pairs)
        assert {r["shape"] for r in res.state.select("shape").distinct().collect()} == {HOT if hot_pairs < 10**6 else 4}
        got = sorted(map(tuple, res.state.drop("shape").collect()), key=str)
        res.release()
        return got

    assert out(1000) == out(10**9)


def test_more_columns_than_a_table_of_masks_holds():
    rng = np.random.default_rng(0)
    left, right = rng.integers(0, 3, (40, 70)), rng.integers(0, 3, (50, 70))
    few = rng.integers(0, 2, (40, 5)), rng.integers(0, 2, (50, 5))
    for a, b in ((left, right), few):
        masks = H.Masks(a)
        masks.add(b[:20])
        masks.add(b[20:])
        width = H.mask_bytes(a.shape[1])
        for t, got in zip(a, masks.lists(10**6)):
            each = [got[i: i + width] for i in range(0, len(got), width)]
            assert set(each) == {np.packbits(x != t).tobytes() for x in b} and len(set(each)) == len(each)
            sizes = [H.flags(m, a.shape[1]).sum() for m in each]
            assert sizes == sorted(sizes)
    cut = H.Masks(few[0])
    cut.add(few[1])
    for whole, part in zip(cut.lists(10**6), cut.lists(6)):  # whole levels, never part of one
        assert whole.startswith(part) and len(part) <= 6
        n = [bin(x).count("1") for x in whole]
        assert len(part) == len(whole) or n[len(part)] > max([-1, *n[: len(part)]])


def test_comparisons_of_one_key_are_dealt_to_tasks(spark):
    """No task compares more than about a group of left classes; the classes of one key come in many tasks."""
    a = spark.range(0, 4000).select(F.lit("k").alias("_k"), H.packed_hashes([F.col("id"), F.col("id") % 7]).alias("_h"))
    b = spark.range(2000, 6000).select(F.lit("k").alias("_k"), H.packed_hashes([F.col("id"), F.col("id") % 7]).alias("_h"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = H.short_lists(a, b, 2, group=100).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in got) == 4000 and max(r["count"] for r in got) < 4000 / 4 and len(got) > 12


def test_guard_raises_before_matching(spark):
    left, right = table(spark, 200, 0, 1, 4), table(spark, 200, 1000, 2, 4)
    with pytest.raises(HotKeyError, match="'hot'"):
        reconcile(left, right, "k", ["c0"], row_id="id", max_pairs=1000)
    res = reconcile(left, right, "k", ["c0"], row_id="id", max_pairs=40_000)
    assert res.pairs.count() > 0
    res.release()


def test_cell_diffs_of_all_shapes(spark):
    rng = random.Random(6)
    left, right = rows(rng, 80, 0), rows(rng, 70, 1000)
    left += [{"id": 500, "k": "one", "o": "x", "a": "p", "b": None, "c": 0.5}]
    right += [{"id": 5000, "k": "one", "o": "x", "a": "q", "b": 3, "c": 0.5}]
    make = lambda rs: spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in rs], test_match.SCHEMA)
    pairs, _, _ = naive(left, right)
    by = {r["id"]: r for r in left + right}
    text = lambda v: "nan" if v is None else str(v)
    want = {(i, m, c, text(by[i][c]), text(by[m][c])) for i, (m, _, d) in pairs.items() for c in d.split(",") if c}
    for hot_pairs in (0, 10**9):
        res = reconcile(make(left), make(right), "k", COLS, order_by=["o"], row_id="id", hot_pairs=hot_pairs)
        assert {tuple(r) for r in res.cell_diffs().collect()} == want and want
        res.release()


def test_nothing_is_left_behind(spark):
    import os
    left, right = table(spark, 50, 0, 1, 4), table(spark, 50, 1000, 2, 4)
    res = reconcile(left, right, "k", ["c0"], row_id="id")
    path = res.scratch.path.removeprefix("file:")
    assert os.path.isdir(path)
    res.release()
    assert not os.path.exists(path)


@pytest.mark.parametrize("share, merged", [(0.02, 64), (0.1, 2)])
def test_heavy_keys_are_all_found(spark, monkeypatch, share, merged):
    """Keys just over the share among very many others, spread over the tasks in turn and in runs; exact counts."""
    from recheck.operators import summary
    monkeypatch.setattr(summary, "MERGED", merged)
    rng = random.Random(9)
    least = int(share * 6000) + 1
    keys = [f"h{i}" for i in range(3) for _ in range(least + i)] + [None] * 50
    keys += [f"x{rng.randrange(4000)}" for _ in range(6000 - 3 * least)]
    for order in (keys, rng.sample(keys, len(keys))):
        df = spark.createDataFrame([(k, "other") for k in order], "key string, k string").repartition(7)
        got = {r["key"]: r["n"] for r in summary.heavy_keys(df, "key", share).collect()}
        counts = {k: order.count(k) for k in ("h0", "h1", "h2")}
        total = sum(k is not None for k in order)
        assert got == {k: n for k, n in counts.items() if n > share * total} and got
    assert summary.heavy_keys(df.limit(0), "key", share).count() == 0


def test_counters_lose_less_than_a_share():
    from recheck.operators.summary import Counters
    rng = random.Random(1)
    keys = ["a"] * 300 + [str(rng.randrange(500)) for _ in range(2000)]
    rng.shuffle(keys)
    parts = [Counters(10) for _ in range(5)]
    for i, k in enumerate(keys):
        parts[i % 5].add([(k, 1)])
    whole = Counters(10)
    for p in parts:
        whole.add(p.n.items())
    assert 300 - len(keys) / 11 <= whole.n["a"] <= 300 and len(whole.n) <= 10


def greedy(left, right):
    """The plain loop over whole rows of numbers: (differing columns, matched, consumed) of each left row."""
    there, out = np.ones(len(right), bool), []
    for t in left:
        rows = np.flatnonzero(there)
        if not len(rows):
            break
        diff = right[rows] != t
        at = int(diff.sum(1).argmin())
        last = int(rows[np.flatnonzero((diff == diff[at]).all(1))[-1]])
        out.append((np.flatnonzero(diff[at]).tolist(), int(rows[at]), last))
        there[last] = False
    return out


def standing(left, right, index_bytes, batch=64):
    seq, out = H.Standing(list(range(len(right))), right, [False] * len(right), [0] * len(right), index_bytes), []
    for at in range(0, len(left), batch):
        part = seq.lookup(left[at: at + batch])
        for j in range(len(part.rows)):
            if seq.left:
                out.append(seq.best(part, j))
                seq.consume(out[-1][2])
    return out, seq


@pytest.mark.parametrize("columns, values", [(1, 3), (5, 2), (6, 40), (12, 3), (8, 10**6)])
@pytest.mark.parametrize("index_bytes", [H.INDEX_BYTES, 1, 20_000])
def test_masks_tried_equal_the_plain_loop(monkeypatch, columns, values, index_bytes):
    """With room for all indexes, for one, and for some; combinations that are numbered and, of many values, hashed."""
    rng = np.random.default_rng(columns)
    right, left = rng.integers(0, values, (400, columns)), rng.integers(0, values, (450, columns))
    edited = rng.random((450, columns)) < 0.7
    left = np.where(edited, right[rng.integers(0, 400, 450)], left)
    right[:, 0] = right[0, 0] if columns > 5 else right[:, 0]  # a column of one value
    want = greedy(left, right)
    assert standing(left, right, index_bytes)[0] == want and len(want) == 400
    monkeypatch.setattr(H, "prod", lambda x: 1 << 62)
    assert standing(left, right, index_bytes)[0] == want


def test_work_of_a_key_grows_with_its_rows():
    """Rows of values that hardly come again are looked up: none is compared with all others, whatever their number."""
    rng = np.random.default_rng(3)
    n = 20_000
    right = np.stack([rng.integers(0, v, n) for v in (4, 3000, 5, 3, n, 2400, 6, 1)], 1)
    left = right[rng.permutation(n)]
    left[::5, 4] += n
    left[::19, 5] = -1
    got, seq = standing(left, right, H.INDEX_BYTES, 10_000)
    assert len(got) == n and len({x[2] for x in got}) == n
    assert seq.scans < n / 50 and len(seq.indexes) <= 2 ** 7


def test_keys_of_some_hundred_rows_are_looked_up(spark, monkeypatch):
    """Without a bound of the caller's, a key of 250 x 240 rows takes the path by indexes, and no list of masks is made."""
    monkeypatch.setattr(H, "short_lists", None)
    left, right = (table(spark, n, id0, seed, 6).withColumn("k", F.lit("k")) for n, id0, seed in ((250, 0, 1), (240, 1000, 2)))
    cols = [f"c{j}" for j in range(6)]

    def out(**kw):
        res = reconcile(left, right, "k", cols, order_by=["o"], row_id="id", **kw)
        got = sorted(map(tuple, res.state.drop("shape").collect()), key=str)
        shapes = {r["shape"] for r in res.state.select("shape").distinct().collect()}
        res.release()
        return got, shapes

    got, shapes = out()
    assert shapes == {HOT} and got == out(hot_pairs=10**9)[0]

"""Greedy reconciliation against a plain Python loop written from the specification."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from recheck.operators.match import _KeyState, reconcile

COLS = ["a", "b", "c"]
SCHEMA = "id long, k string, o string, a string, b long, c double"


def naive(left, right, consume_exact=True):
    def order(r):
        return (r["o"] is None, r["o"] or "", r["id"])

    L = sorted(left, key=order)
    R = sorted(right, key=order)
    used = set()
    pairs, left_only = {}, {}
    keys_r = {r["k"] for r in R if r["k"] is not None}
    for l in L:
        cands = [r for r in R if r["k"] is not None and r["k"] == l["k"] and r["id"] not in used]
        if not cands:
            left_only[l["id"]] = "no_key" if l["k"] not in keys_r else "used_up"
            continue
        diffs = [[c for c in COLS if l[c] != r[c]] for r in cands]
        best = min(range(len(cands)), key=lambda i: len(diffs[i]))
        d = diffs[best]
        last = max(i for i in range(len(cands)) if diffs[i] == d)
        consumed = cands[last]["id"]
        if not consume_exact and len(cands) == 1 and not d and all(cands[0][c] is not None for c in COLS):
            consumed = None
        else:
            used.add(consumed)
        pairs[l["id"]] = (cands[best]["id"], consumed, ",".join(d))
    right_only = {r["id"] for r in R if r["id"] not in used}
    return pairs, left_only, right_only


def rows(rng, n, id0):
    out = []
    for i in range(n):
        out.append({"id": id0 + i, "k": rng.choice(["a", "b", "c", "d", None, "e", "a", "a"]),
                    "o": rng.choice(["x", "y", None]), "a": rng.choice(["p", "q", None]),
                    "b": rng.choice([1, 2, None]), "c": rng.choice([0.5, 1.5, None])})
    return out


def run(spark, left, right, **kw):
    ldf = spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in left], SCHEMA)
    rdf = spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in right], SCHEMA)
    res = reconcile(ldf, rdf, "k", COLS, order_by=["o"], row_id="id", **kw)
    pairs = {r.row_id: (r.matched_id, r.consumed_id, ",".join(r.diff_columns))
             for r in res.pairs.collect()}
    lo = {r.row_id: r.reason for r in res.left_only.collect()}
    ro = {r.row_id for r in res.right_only.collect()}
    res.release()
    return pairs, lo, ro


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("fast", [True, False])
def test_reconcile_equals_naive(spark, seed, fast):
    rng = random.Random(seed)
    left, right = rows(rng, 45, 0), rows(rng, 40, 1000)
    got = run(spark, left, right, fast_paths=fast)
    assert got == naive(left, right)


def test_invariants(spark):
    rng = random.Random(7)
    left, right = rows(rng, 60, 0), rows(rng, 50, 1000)
    pairs, lo, ro = run(spark, left, right)
    assert set(pairs) | set(lo) == {r["id"] for r in left} and not set(pairs) & set(lo)
    consumed = [v[1] for v in pairs.values()]
    assert len(consumed) == len(set(consumed))
    assert len(consumed) + len(ro) == len(right)


@pytest.mark.parametrize("seed", [4])
def test_not_consumed_exact(spark, seed):
    rng = random.Random(seed)
    left, right = rows(rng, 40, 0), rows(rng, 30, 1000)
    for fast in (True, False):
        assert run(spark, left, right, consume_exact=False, fast_paths=fast) == naive(left, right, False)


def test_reported_and_consumed_differ(spark):
    # two candidates with the same diff list: the first is reported, the last is consumed
    left = [{"id": 1, "k": "a", "o": "x", "a": "p", "b": 1, "c": 0.5},
            {"id": 2, "k": "a", "o": "y", "a": "p", "b": 1, "c": 0.5}]
    right = [{"id": 10, "k": "a", "o": "x", "a": "q", "b": 1, "c": 0.5},
             {"id": 11, "k": "a", "o": "y", "a": "z", "b": 1, "c": 0.5}]
    pairs, lo, ro = run(spark, left, right)
    assert pairs[1] == (10, 11, "a")
    assert pairs[2] == (10, 10, "a")
    assert not lo and not ro


def test_case_insensitive_mode(spark):
    left = [{"id": 1, "k": "a", "o": "x", "a": " P", "b": 1, "c": 0.5}]
    right = [{"id": 10, "k": "a", "o": "x", "a": "p", "b": 1, "c": 0.5},
             {"id": 11, "k": "a", "o": "x", "a": "q", "b": 1, "c": 0.5}]
    pairs, _, ro = run(spark, left, right, mode="ci", trim_left=True)
    assert pairs[1] == (10, 10, "") and ro == {11}


def test_n_by_m_plan_has_no_cartesian(spark):
    rng = random.Random(1)
    left, right = rows(rng, 20, 0), rows(rng, 20, 100)
    ldf = spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in left], SCHEMA)
    rdf = spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in right], SCHEMA)
    res = reconcile(ldf, rdf, "k", COLS, order_by=["o"], row_id="id")
    plan = res.pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python UDF
    res.release()


def test_not_consumed_exact_ci_mode(spark):
    # case-only difference: no diff under 'ci', but not raw-equal -> consumed; exact raw copy -> kept available
    left = [{"id": 1, "k": "a", "o": "x", "a": "P", "b": 1, "c": 0.5},
            {"id": 2, "k": "a", "o": "y", "a": "p", "b": 1, "c": 0.5},
            {"id": 3, "k": "b", "o": "x", "a": "p", "b": 1, "c": None},
            {"id": 4, "k": "b", "o": "y", "a": "p", "b": 1, "c": None}]
    right = [{"id": 10, "k": "a", "o": "x", "a": "p", "b": 1, "c": 0.5},
             {"id": 11, "k": "b", "o": "x", "a": "p", "b": 1, "c": None}]
    for fast in (True, False):
        pairs, lo, ro = run(spark, left, right, mode="ci", consume_exact=False, fast_paths=fast)
        assert pairs[1] == (10, 10, "")          # 'P' vs 'p': equal under ci, not raw-equal -> consumed
        assert 2 in lo                           # nothing left for the second row of key a
        assert pairs[3] == (11, 11, "")          # NULL on the baseline row: not exact -> consumed
        assert ro == set()


def test_carry_left_columns(spark):
    rng = random.Random(3)
    left, right = rows(rng, 30, 0), rows(rng, 30, 100)
    ldf = spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in left], SCHEMA)
    rdf = spark.createDataFrame([tuple(r[c] for c in ["id", "k", "o"] + COLS) for r in right], SCHEMA)
    res = reconcile(ldf, rdf, "k", COLS, order_by=["o"], row_id="id", carry=["o"])
    got = {r.row_id: r.o for r in res.with_left(res.pairs, ["o"]).collect()}
    assert got == {r["id"]: r["o"] for r in left if r["id"] in got} and len(got) == res.pairs.count()


def test_big_keys_and_hot_one_to_many(spark):
    # keys with > 24 value classes take the vectorised path; key "h" is a hot 1 x m key (one left row)
    rng = random.Random(11)

    def big_rows(n, id0, keys):
        return [{"id": id0 + i, "k": rng.choice(keys), "o": rng.choice(["x", "y", "z", None]),
                 "a": rng.choice(["p", "q", "r", "s", None]), "b": rng.choice([1, 2, 3, 4, 5, None]),
                 "c": rng.choice([0.5, 1.5, 2.5, None])} for i in range(n)]
    left = big_rows(150, 0, ["a", "b"]) + [{"id": 999, "k": "h", "o": "x", "a": "q", "b": 2, "c": 1.5}]
    right = big_rows(140, 1000, ["a", "b"]) + big_rows(300, 5000, ["h"])
    for fast in (True, False):
        assert run(spark, left, right, fast_paths=fast) == naive(left, right)


# -- cell types: one comparison, whatever path a key takes -----------------------------------------------------------

NAN = float("nan")
FAR = datetime.datetime(9999, 12, 31, 23, 59, 59)
TYPED = ("id long, k long, o string, f double, n long, t timestamp, d date, m decimal(20,4), s string, x array<int>, "
         "b boolean")
TCOLS = ["f", "n", "t", "d", "m", "s", "x", "b"]
CHOICES = {"f": [None, NAN, 0.0, -0.0, 1.5, 1e300], "n": [None, 9007199254740992, 9007199254740993, -1],
           "t": [None, FAR, datetime.datetime(2020, 1, 1)], "d": [None, datetime.date(2020, 1, 1), datetime.date(9999, 12, 31)],
           "m": [None, Decimal("1.0000"), Decimal("1.0001")], "s": [None, "nan", "", "NULL", "a"],
           "x": [None, [], [1], [1, 2]], "b": [None, True, False]}


def typed_rows(rng, n, id0, keys):
    return [(id0 + i, rng.choice(keys), rng.choice(["x", "y", None]), *[rng.choice(CHOICES[c]) for c in TCOLS])
            for i in range(n)]


def as_dicts(rows):
    def plain(v):  # NaN is a null, -0.0 is 0.0, lists compare by value
        if isinstance(v, float):
            return None if v != v else v + 0.0
        return tuple(v) if isinstance(v, list) else v
    return [dict(zip(["id", "k", "o", *TCOLS], map(plain, r))) for r in rows]


@pytest.mark.parametrize("fast", [True, False])
def test_every_type_compares_alike_on_all_paths(spark, monkeypatch, fast):
    rng = random.Random(11)
    left = typed_rows(rng, 60, 0, [2**60, 2, 3, 4, 5, 6, 7, 8, 9, None])
    right = typed_rows(rng, 60, 1000, [2**60, 2, 3, 4, 20, 21, 22, 23, 5, 6, 7, None])
    monkeypatch.setitem(globals(), "COLS", TCOLS)
    res = reconcile(spark.createDataFrame(left, TYPED), spark.createDataFrame(right, TYPED), "k", TCOLS, order_by=["o"],
                    row_id="id", fast_paths=fast)
    got = {r.row_id: (r.matched_id, r.consumed_id, ",".join(r.diff_columns)) for r in res.pairs.collect()}
    want = naive(as_dicts(left), as_dicts(right))
    assert got == want[0]
    assert {r.row_id: r.reason for r in res.left_only.collect()} == want[1]
    assert {r.row_id for r in res.right_only.collect()} == want[2]
    assert res.pairs.schema["key"].dataType.simpleString() == "bigint"


def test_other_types_on_the_other_side(spark):
    left = spark.createDataFrame([(1, "a", 10000000, "7", datetime.date(2020, 1, 2), Decimal("1.50"), "1e7")],
                                 "id long, k string, n long, s string, d date, m decimal(10,2), u string")
    right = spark.createDataFrame([(9, "a", 1e7, 7, datetime.datetime(2020, 1, 2), 1.5, 1e7)],
                                  "id long, k string, n double, s long, d timestamp, m double, u double")
    cols = ["n", "s", "d", "m", "u"]
    for mode in ("exact", "ci"):
        res = reconcile(left, right, "k", cols, row_id="id", mode=mode)
        assert res.pairs.first().diff_columns == ["u"]  # a text is compared as it is written


def test_more_columns_than_bits(spark):
    cols = [f"c{i}" for i in range(70)]
    rng = random.Random(3)
    make = lambda id0, n: [(id0 + i, "k", *[rng.choice(["p", "q"]) for _ in cols]) for i in range(n)]
    left, right = make(0, 3), make(100, 40)
    schema = "id long, k string, " + ", ".join(f"{c} string" for c in cols)
    res = reconcile(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "k", cols, row_id="id")
    used, want = set(), {}
    for r in left:
        diffs = [(sum(a != b for a, b in zip(r[2:], x[2:])), i) for i, x in enumerate(right) if i not in used]
        n, i = min(diffs)
        want[r[0]] = (right[i][0], n)
        used.add(i)  # no two rows differ in the same columns here
    assert {r.row_id: (r.matched_id, r.n_diff) for r in res.pairs.collect()} == want


def test_hot_1_by_m_key_and_bounded_profiles(spark, monkeypatch):
    left = spark.createDataFrame([(1, "a", "x")], "id long, k string, v string")
    right = spark.range(100, 400).selectExpr("id", "'a' AS k", "cast(id % 7 AS string) AS v")
    res = reconcile(left, right, "k", ["v"], row_id="id")
    assert res.pairs.first().matched_id == 100
    one = _KeyState("a", 1)
    monkeypatch.setattr(_KeyState, "CACHE_BYTES", 1)  # profiles are computed anew, with the same results
    for i in range(50):
        one.add_right(i, (str(i % 30),), None)
    seen = [one.match((str(100 + j),), None, True) for j in range(50)]
    assert [s[0] for s in seen] and len(one.cache) <= 1 and len({s[1] for s in seen}) == 50


def test_row_ids_must_be_whole_numbers(spark):
    df = spark.createDataFrame([("r1", "a", "x")], "id string, k string, v string")
    with pytest.raises(TypeError, match="whole number"):
        reconcile(df, df, "k", ["v"], row_id="id")

"""Rewrites against their literal pandas/numpy form."""

import re

import numpy as np
import pandas as pd

from recheck.operators import stats as ST
from recheck.operators import summary as S

ROWS_A = [("x", 1.0, None), ("x", 1.0, None), ("y", None, "k"), (None, 2.0, "k")]
ROWS_B = [("x", 1.0, None), ("y", None, "k"), ("y", None, "k"), ("z", 3.0, None)]
SCHEMA = "f string, v double, s string"


def test_outer_completeness_matches_pandas_merge(spark):
    a, b = spark.createDataFrame(ROWS_A, SCHEMA), spark.createDataFrame(ROWS_B, SCHEMA)
    got = {r.field: r.match_pct for r in S.outer_completeness(a, b, ["f", "v", "s"]).collect()}
    m = pd.DataFrame(ROWS_A, columns=["f", "v", "s"]).merge(pd.DataFrame(ROWS_B, columns=["f", "v", "s"]), how="outer")
    for c in ["f", "v", "s"]:
        exp = 100 - round(m[c].isnull().sum() / len(m) * 100, 2)
        assert abs(got[c] - exp) < 1e-9


def test_duplicate_rows(spark):
    df = spark.createDataFrame(ROWS_A + ROWS_B, SCHEMA)
    pdf = pd.DataFrame(ROWS_A + ROWS_B, columns=["f", "v", "s"])
    assert S.duplicate_rows(df).first().duplicate_rows == int(pdf.duplicated(keep=False).sum())
    assert S.duplicate_rows(df, threshold=100).first().duplicate_rows == 0


def test_mismatch_counts_null_safe(spark):
    gt = spark.createDataFrame([("k1", "f1", None), ("k2", "f1", "a"), ("k3", "f2", "b")], "key string, file string, v string")
    pl = spark.createDataFrame([("k1", "f1", None), ("k2", "f1", "b")], "key string, file string, v string")
    m = S.outer_by_key(gt, pl, "key")
    got = {(r.file_name, r.field): r.mismatches for r in S.mismatch_counts(m, ["v"], "file_gt").collect()}
    assert got == {("f1", "v"): 1, ("f2", "v"): 1}


def test_price_stats_match_numpy(spark):
    rows = [(1, "n1", 10.0, "c", "u"), (2, "n1", 20.0, "c", "u"), (3, "n1", 40.0, "d", "v"),
            (4, "n2", 5.0, "c", "u"), (5, "n2", None, "c", "u"), (6, None, 7.0, "e", "w"), (7, "n3", 0.0, "c", "u")]
    df = spark.createDataFrame(rows, "row_id long, sku_normalized string, unit_price double, level5_category string, "
                                     "uom string")
    df = ST.drop_zero(df)
    assert 7 not in {r.row_id for r in df.collect()}
    per = {r.row_id: r for r in ST.price_stats_per_row(df).collect()}
    assert per[1].no_of_price_points == 2 and per[1].low_price == 10.0
    assert abs(per[1].percentile_25th - np.percentile([10, 20, 40], 25)) < 1e-9
    assert per[4].percentile_25th is None                    # a NaN in the group -> NaN percentile
    assert per[4].avg_price == 5.0 and per[6].avg_price is None
    by = {r.sku_normalized: r for r in ST.price_stats_by_name(df).collect()}
    assert by["n1"].no_of_price_points == 3 and by["n1"].level5_category == "c"
    assert by[None].no_of_price_points is None and by[None].level5_category == "e"
    first = {r.sku_normalized: r.row_id for r in ST.drop_duplicates_first(df, ["sku_normalized"]).collect()}
    assert first == {"n1": 1, "n2": 4, None: 6}


def test_pair_free_merge_summaries_equal_literal_merge(spark):
    g = [("k1", "f1", "a"), ("k1", "f1", "a"), ("k1", "f2", "b"), ("k2", "f1", None), ("k2", "f1", None),
         ("k3", "f2", "c"), ("k3", "f2", "c"), ("k4", "f1", "d")]
    p = [("k1", "a"), ("k1", "a"), ("k1", "z"), ("k2", None), ("k5", "q"), ("k5", "q"), ("k4", "d")]
    gt = spark.createDataFrame(g, "key string, file string, v string")
    pl = spark.createDataFrame(p, "key string, v string")
    merged = S.outer_by_key(gt, pl, "key")
    lit_dup = S.duplicate_rows(merged, ["key_gt", "file_gt", "v_gt", "key_pl", "v_pl"]).first().duplicate_rows
    pf_dup = S.merge_duplicate_rows(gt, pl, "key", ["key", "file", "v"], ["key", "v"]).first().duplicate_rows
    assert pf_dup == lit_dup and pf_dup > 0
    lit_by = {r.file_gt: r.duplicate_rows for r in
              S.duplicate_rows(merged, ["key_gt", "file_gt", "v_gt", "key_pl", "v_pl"], by="file_gt").collect()}
    pf_by = {r.file: r.duplicate_rows for r in
             S.merge_duplicate_rows(gt, pl, "key", ["key", "file", "v"], ["key", "v"], by="file").collect()}
    assert {k: v for k, v in lit_by.items() if v} == {k: v for k, v in pf_by.items() if v}
    lit_mm = {(r.file_name, r.field): r.mismatches for r in S.mismatch_counts(merged, ["v"], "file_gt").collect()}
    pf_mm = {(r.file_name, r.field): r.mismatches for r in S.key_mismatch_counts(gt, pl, "key", ["v"], "file").collect()}
    assert lit_mm == pf_mm
    prof = {r.key: (r.gt_rows, r.pl_rows, r.merged_rows) for r in S.merge_profile(gt, pl, "key").collect()}
    assert sum(v[2] for v in prof.values()) == merged.count()


def test_mark_duplicates(spark):
    df = spark.createDataFrame(ROWS_A + ROWS_B, SCHEMA)
    pdf = pd.DataFrame(ROWS_A + ROWS_B, columns=["f", "v", "s"])
    got = sorted(r.has_copy for r in S.mark_duplicates(df, ["f", "v", "s"]).collect())
    assert got == sorted(pdf.duplicated(keep=False).tolist())


def random_sides(spark, seed):
    import random
    rng = random.Random(seed)
    def make(n, id0, files):
        return [(id0 + i, rng.choice(["k1", "k2", "k3", "k4", None]), rng.choice(files), rng.choice(["p", "q", None]),
                 rng.choice([1, 2, None])) for i in range(n)]
    schema = "row_id long, key string, file_name string, a string, b long"
    return (spark.createDataFrame(make(60, 0, ["f1", "f2", None]), schema),
            spark.createDataFrame(make(50, 1000, ["f1", "f9", None]), schema))


def test_one_table_of_sums_equals_the_single_measures(spark):
    """All measures at once against the operators of one measure each; NULL keys and files, keys of one side only."""
    cols, side = ["a", "b"], ["key", "file_name", "a", "b"]
    for seed in (1, 2):
        gt, pl = random_sides(spark, seed)
        if seed == 2:
            gt, pl = gt.where("key <> 'k1' OR key IS NULL"), pl.where("key <> 'k2' OR key IS NULL")
        m = S.file_measures(gt, pl, "key", cols, dup_cols=(side, side), complete=(pl, gt, ["file_name", "a", "b"]))
        got = S.file_table(m, cols)
        want = S.file_level_accuracy(gt, pl, "key", cols, dup_cols=(side, side))
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        total = S.merge_duplicate_rows(gt, pl, "key", side, side)
        old = S.issue_summary(want, cols, S.outer_completeness(pl, gt, ["file_name", "a", "b"]).where("field <> 'file_name'"), total)
        new = S.issue_table(m, cols)
        assert new.columns == old.columns
        assert sorted(map(tuple, new.collect()), key=str) == sorted(map(tuple, old.collect()), key=str)


def test_issue_table_is_one_plan_of_few_exchanges(spark):
    gt, pl = random_sides(spark, 3)
    side = ["key", "file_name", "a", "b"]
    m = S.issue_table(S.file_measures(gt, pl, "key", ["a", "b"], dup_cols=(side, side),
                                      complete=(pl, gt, ["file_name", "a", "b"])), ["a", "b"])
    m.collect()
    plan = m._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    shuffles = {x for line in plan.splitlines() for x in re.findall(r"^[^A-Za-z]*Exchange .*plan_id=(\d+)", line)}
    assert len(shuffles) <= 8 and "ReusedExchange" in plan and "Join" not in plan, plan

"""Positions and exact ranks over range partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from recheck.operators import stats as ST
from recheck.operators.order import in_order, percentiles, with_position
from recheck.session import Scratch


def test_positions_equal_a_sort(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", None, "c"]), rng.choice([1, 2, None])) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id long, a string, n int").repartition(5)
    got = {r.position: r.row_id for r in with_position(df, ["a", "-n"]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or "", r[2] is None, -(r[2] or 0), r[0]))
    assert [got[k + 1] for k in range(500)] == [r[0] for r in want]
    assert with_position(df.limit(0), ["a"]).count() == 0
    plan = with_position(df, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentiles_equal_numpy(spark, q):
    rng = random.Random(int(q * 100))
    rows = [("one", 7.5), (None, 1.0), ("none", None)] + [("hot", float(rng.randint(0, 40))) for _ in range(900)]
    rows += [(f"g{i % 7}", rng.random() * 100) for i in range(200)] + [("two", 1.0), ("two", 2.0), ("hot", None)]
    got = {r.g: r.percentile for r in percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", q).collect()}
    for g in {r[0] for r in rows} - {None, "none"}:
        assert got[g] == pytest.approx(np.percentile([v for k, v in rows if k == g and v is not None], q * 100))
    assert set(got) == {r[0] for r in rows} - {None, "none"}


def test_no_task_holds_a_hot_item(spark):
    """A million distinct prices of one item: each range holds less than a sixteenth of them."""
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit("hot").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7).alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        scratch = Scratch(spark, "test")
        rows = in_order(df, [F.col("g").asc(), F.col("v").asc()], scratch, "x")
        sizes = [r["count"] for r in rows.groupBy(F.shiftright("_place", 33)).count().collect()]
        got = percentiles(df, "g", "v", 0.25).first().percentile
        scratch.drop()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 1_000_000 and max(sizes) < 1_000_000 / 16
    assert got == pytest.approx(df.agg(F.percentile("v", 0.25)).first()[0])


def test_hot_items_have_the_statistics_of_others(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot", "hot", "hot", "a", "b", None, "null"]), rng.choice([1.0, 2.5, 9.0, 4.0]), "c", "u")
            for i in range(400)]
    rows += [(1000, "null", None, "c", "u"), (1001, "hot2", None, "c", "u")] + [(2000 + i, "hot2", 3.0, "c", "u") for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, sku_normalized string, unit_price double, level5_category string, uom string")
    for f in (ST.price_stats_by_name, ST.price_stats_per_row):
        a, b = f(df, hot_points=50), f(df, hot_points=None)
        assert a.columns == b.columns
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)

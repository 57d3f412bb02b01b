"""Keys, number texts and payment terms without a regular expression a row equal those with one; inputs derived once."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recheck.functions import cells as C
from recheck.operators import rules as R

TEXTS = ["", "a", "Ab-9 (std)", "\x00a\x01b\x7f", "é", "Straße 9", "x\ty\nz", "日本 A1", "a b", "½x²", None, "__", "'\"\\", "\U0001F600a",
         "NET30", "NET 30", "NET", "net45", "NET30\n", "NET30\r\n", "NET30\n\n", "NET3\u0085", "xNET30", "NET30x", "NET٣", "NeT7", "\n",
         "NET3\r", "NET\n", "30NET", "N3ET", "NET3 "]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("pattern", [C.ASCII_ALNUM_STRIP, C.UNICODE_ALNUM_STRIP])
def test_characters_taken(spark, pattern):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").unionByName(
        spark.range(1).select(F.expr("cast(X'61FF2D62' as string)").alias("t")))
    got = df.select(F.hex(C._without(F.col("t"), pattern)).alias("a"), F.hex(F.regexp_replace("t", pattern, "")).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert "translate" in plan(C.pseudo_key(df, ["t"]))  # the texts of ASCII go without a regular expression


def test_number_texts(spark):
    rng = random.Random(2)
    values = [0.0, -0.0, 10.0, 10.5, -100.50, 1e15, 1e18, 1.5e38, 1e40, 1e-7, 5e-4, math.inf, -math.inf, math.nan, None, 0.01, 120.0]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 40) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def old(text):
        return F.when(text.rlike(r"^-?[0-9]+\.[0-9]+$"), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)

    got = df.select("v", C.number_text("v", T.DoubleType()).alias("a")).collect()
    assert {r.a for r in got if r.v in (10.0, 10.5, -100.5, 120.0)} == {"10", "10.5", "-100.5", "120"}
    assert [r.a for r in got if r.v in (5e-4, 1e-7)] == ["0.0000001", "0.0005"]
    dec = df.where("abs(v) < 1e20").select(F.col("v").cast("decimal(38,10)").alias("d"))
    both = dec.select(C.number_text("d", T.DecimalType(38, 10)).alias("a"), old(C._expanded(F.col("d").cast("string"))).alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both]


def test_payment_terms(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select(R.starts_then_digits(F.col("t"), "NET", R.PAYMENT_TERM_STRICT).alias("a"), F.col("t").rlike(R.PAYMENT_TERM_STRICT).alias("b"),
                    R.starts_then_digits(F.lower("t"), "net", R.PAYMENT_TERM_LENIENT).alias("c"),
                    F.lower("t").rlike(R.PAYMENT_TERM_LENIENT).alias("d")).collect()
    assert [r.a for r in got] == [r.b for r in got] and [r.c for r in got] == [r.d for r in got] and any(r.a for r in got)


def test_large_lookups_read_the_input_once(spark):
    """With sets too large for a broadcast, the violations read what was written, not the input again."""
    df = spark.createDataFrame([(i, f"item{i % 7}", "A" if i % 3 else None, "NET30" if i % 2 else "x") for i in range(60)],
                               "row_id long, sku_normalized string, uom string, payment_term string").withColumn("uom", F.rand(3).cast("string"))
    lookup = spark.createDataFrame([(f"item{i}", "A") for i in range(5)], "normalized_name string, normalized_uom string").withColumns(
        {"level_5": F.lit("c"), "original_name": F.lit("o"), "remove_flag": F.lit("no"), "price": F.lit(1.0), "price_outlier": F.lit("no")})
    rs = R.build_rules(df, norm_lookup=lookup, price_columns=())
    small, large = rs.violations(), rs.violations(max_bytes=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert "rand(" in plan(small) and "rand(" not in plan(large)


def test_flow_reads_its_sides_once(spark, tmp_path):
    from recheck import flows
    rows = [(i, f"f{i % 3}", f"s{i % 5}") for i in range(40)]
    left = spark.createDataFrame(rows, "row_id long, file_name string, s string").withColumn("x", F.rand(3))
    out = flows.compare(left, left, ["file_name", "s"], str(tmp_path))
    assert all("rand(" not in plan(out[k]) for k in ("matched", "left_only", "right_only"))
    assert spark.read.parquet(f"{tmp_path}/matched").where("diff_columns = ''").count() == 40

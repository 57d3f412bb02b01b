"""The flows from tables to written results."""

from recheck import flows
from recheck.operators import summary as S

COLS = "row_id long, file_name string, sku string, price double, payment_term string"
LEFT = [(1, "f1", "a", 1.0, "NET30"), (2, "f1", "b ", 2.0, "NET30"), (3, "f2", "c", -3.0, "soon"), (4, "f1", "z", 1.0, None)]
RIGHT = [(11, "f1", "a", 1.0, "NET30"), (12, "f1", "b", 2.5, "NET30"), (13, "f1", "q", 9.0, None)]


def test_compare_writes_whole_rows(spark, tmp_path):
    left = spark.createDataFrame(LEFT, COLS).withColumn("only_here", S.F.lit("x"))
    right = spark.createDataFrame(RIGHT, COLS)
    out = flows.compare(left, right, ["file_name", "sku"], str(tmp_path))
    read = {n: spark.read.parquet(str(tmp_path / n)) for n in out}
    assert [(r.row_id, r.sku, r.matched_id, r.diff_columns) for r in read["matched"].orderBy("row_id").collect()] == [
        (1, "a", 11, ""), (2, "b ", 12, "sku,price")]
    assert {(r.row_id, r.reason) for r in read["left_only"].collect()} == {(3, "no_key"), (4, "no_key")}
    assert [r.row_id for r in read["right_only"].collect()] == [13]
    assert {r.metric: r.value for r in read["totals"].collect()} == {"matched": 2, "left_only": 2, "right_only": 1}
    assert [tuple(r) for r in read["columns"].collect()] == [("only_here", "left")]


def test_flat_file_against_an_extract(spark):
    left = spark.createDataFrame(LEFT, COLS)
    right = spark.createDataFrame([(r[0], r[1], r[2].upper(), *r[3:]) for r in RIGHT], COLS.replace("price double", "PRICE string"))
    out = flows.flat_vs_extract(left, right, ["file_name"])
    got = {r.row_id: r.diff_columns for r in out["matched"].collect()}
    assert got[1] == "price"  # a text is compared as it is written: '1.0' there, 1 here
    assert len(got) == 3


def test_business_checks_take_groups_without_a_baseline(spark):
    left, right = spark.createDataFrame(LEFT, COLS), spark.createDataFrame(RIGHT, COLS)
    out = flows.business_checks(left, right, ["file_name"], ["file_name", "sku"], price_columns=["price"])
    assert {(r.row_id, r.rule) for r in out["violations"].collect()} == {(3, "R3"), (3, "R5"), (3, "R6")}
    assert {r.row_id for r in out["compare_matched"].collect()} == {1, 2}
    assert out["rules_not_run"].where("rule = 'R7'").count() == 1


def test_threshold_is_for_the_total_only(spark):
    df = spark.createDataFrame([("f", "a"), ("f", "a"), ("g", "b")], "file_name string, v string")
    assert S.duplicate_rows(df, by="file_name", threshold=100).first().duplicate_rows == 2
    assert S.duplicate_rows(df, threshold=100).first().duplicate_rows == 0


def test_mismatches_compare_numbers_of_other_types(spark):
    gt = spark.createDataFrame([("k1", "f", 10), ("k2", "f", 11)], "key string, file_name string, v long")
    pl = spark.createDataFrame([("k1", 10.0), ("k2", 11.5)], "key string, v double")
    assert S.key_mismatch_counts(gt, pl, "key", ["v"]).first().mismatches == 1

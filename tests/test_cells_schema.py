"""Key builders, normalisers and schema alignment."""

import pytest
from pyspark.sql import functions as F

from recheck.functions.cells import (cell_text, clean_cells, clean_sides, lower_strings, nan_to_null, normalize_dates,
                                     pseudo_key)
from recheck.operators.schema import align, canonical_headers, contract_report, schema_diff


def test_key_variants(spark):
    df = spark.createDataFrame([("Ab-C 1", "f.x", None, "Été²")], "s string, f string, u string, w string")
    a = pseudo_key(df, ["s", "f", "u"], "ascii_lower").first().pseudo_key
    b = pseudo_key(df, ["f", "s"], "ascii_case").first().pseudo_key
    c = pseudo_key(df, ["f", "w"], "unicode_lower").first().pseudo_key
    assert a == "abc1fxnan"          # NULL renders as 'nan'
    assert b == "fxAbC1"             # case kept, '-' joiner stripped
    assert c == "fxété²"             # Unicode letters and digits survive
    assert pseudo_key(df, ["s"], "ascii_lower").columns[0] == "pseudo_key"
    with pytest.raises(ValueError):
        pseudo_key(df, ["nope"])


def test_normalize_dates_all_or_nothing(spark):
    df = spark.createDataFrame([("2020-01-05", "2020-02-03"), ("2021-03-04 10:00:00", "junk")], "a string, b string")
    out = normalize_dates(df, ["a", "b"]).collect()
    assert [r.a for r in out] == ["2020-01-05", "2021-03-04"]
    assert [r.b for r in out] == ["2020-02-03", "junk"]        # one bad value: column left as it was
    out2 = normalize_dates(df, ["b"], on_error="null").collect()
    assert [r.b for r in out2] == ["2020-02-03", None]


def test_clean_lower_nan(spark):
    df = spark.createDataFrame([(" X ", float("nan"), 1)], "s string, d double, i long")
    assert nan_to_null(df).first().d is None
    r = clean_cells(nan_to_null(df)).first()
    assert (r.s, r.d, r.i) == ("X", "nan", "1")
    left, right = clean_sides(df, df, trim="left")  # the flat file's side is stripped, the other is not
    assert left.first().s == "X" and right.first().s == df.first().s
    assert lower_strings(df).first().s == " x "
    assert df.select(cell_text(F.lit(None).cast("string")).alias("t")).first().t == "nan"


def test_align_and_schema(spark):
    a = spark.createDataFrame([(1, "x", "t", 2)], "id long, Name string, System_DateTime string, only_a long")
    b = spark.createDataFrame([("y", 1, 5)], "Name string, id long, only_b long")
    d = {(r.column, r.side) for r in schema_diff(spark, a, b).collect()}
    assert d == {("System_DateTime", "left"), ("only_a", "left"), ("only_b", "right")}
    with _Capture() as cap:
        ac, bc = align(a, b, how="common")
    assert any("only_a" in m and "only_b" in m for m in cap.messages)
    assert ac.columns == bc.columns == ["id", "Name"]
    al, bl = align(a, b, how="left")
    assert bl.columns == ["id", "Name", "only_a"] and bl.first().only_a is None
    dl, db = align(a, b, how="common", lower=True, sort=True)
    assert dl.columns == ["id", "name"]
    assert canonical_headers(a).columns == ["id", "name", "systemdatetime", "onlya"]
    with pytest.raises(ValueError):
        canonical_headers(spark.createDataFrame([(1, 2)], "`A b` long, `ab` long"))
    rep = {(r.sub_category, r.field) for r in contract_report(spark, a, ["id", "Name", "missing"]).collect()}
    assert rep == {("Missing Columns", "missing"), ("Extra Columns", "System_DateTime"), ("Extra Columns", "only_a")}


class _Capture(__import__("logging").Handler):
    def __init__(self):
        super().__init__()
        self.messages = []

    def emit(self, record):
        self.messages.append(record.getMessage())

    def __enter__(self):
        import logging
        logging.getLogger("recheck.operators.schema").addHandler(self)
        return self

    def __exit__(self, *a):
        import logging
        logging.getLogger("recheck.operators.schema").removeHandler(self)


def test_dtype_conformance_of_values_and_declared_types(spark):
    from recheck.operators.profile import dtype_conformance
    df = spark.createDataFrame([(1.5, 2.0, 7, "x", "1", "1.5", 5, "2020-01-01"), (2.0, 3.0, 8, "y", "2", "2", 6, "2020-13-01")],
                               "half double, whole double, num long, s string, i string, j string, e long, t string")
    got = {r.field: r.n_bad for r in dtype_conformance(df, {
        "half": "int64", "whole": "int64", "num": "object", "s": "object", "i": "int64", "j": "int64",
        "e": "datetime64[ns]", "t": "datetime64[ns]"}).collect()}
    assert got == {"half": 1, "num": 2, "j": 1, "e": 2, "t": 1}


def test_white_space_is_stripped_as_python_does(spark):
    texts = ["  a\t", "\r\n b \u00a0", "\u2003c\u3000", "d\x1c", "", " \t "]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert [r.s for r in clean_cells(df).collect()] == [t.strip() for t in texts]


def test_number_text_is_one_for_each_number(spark):
    from recheck.functions.cells import number_text
    df = spark.sql("SELECT 10 AS a, 10D AS b, 10.00BD AS c, 1e7 AS d, 0.1D AS e, 0.10BD AS f, -0.0D AS g, 1e300 AS h, "
                   "double('NaN') AS i, 100BD AS j, 1234567.875D AS k, 0.1F AS l")
    row = df.select(*[number_text(c, df.schema[c].dataType).alias(c) for c in df.columns]).first()
    assert tuple(row) == ("10", "10", "10", "10000000", "0.1", "0.1", "0", "1.0E300", None, "100", "1234567.875", "0.1")


def test_number_text_of_small_and_large_doubles_is_plain(spark):
    from recheck.functions.cells import number_text
    texts = ["0.0005", "-0.0005", "0.0000001", "0.00000012345", "0.009", "1000000000000000000", "-1000000000000000000",
             "1234567890123456800000", "1125899906842624.2", "2251799813685248.5", "0.01", "1000000000000000", "0", "-1.5"]
    for kind in ("double", "decimal(38,12)"):
        df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("v", F.col("t").cast(kind))
        got = df.select("t", number_text("v", df.schema["v"].dataType).alias("n")).collect()
        assert [r.n for r in got] == [r.t for r in got], kind
    row = spark.sql("SELECT 1e-40D AS a, 1.5e-12F AS b, 9.5e37D AS c, 1000000000000000000 AS d, double('Infinity') AS e, "
                    "4.9e-324D AS f")
    got = row.select(*[number_text(c, row.schema[c].dataType).alias(c) for c in row.columns]).first()
    assert tuple(got) == ("0." + "0" * 39 + "1", "0.0000000000015", "95" + "0" * 36, "1" + "0" * 18, "Infinity",
                          "0." + "0" * 323 + "49")
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")  # then a decimal's own text has an exponent too
    try:
        df = spark.sql("SELECT CAST('0.0000001' AS DECIMAL(20,18)) AS a, CAST(0 AS DECIMAL(20,18)) AS b")
        assert tuple(df.select(*[number_text(c, df.schema[c].dataType) for c in df.columns]).first()) == ("0.0000001", "0")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)


def test_equal_numbers_of_other_types_are_not_reported(spark):
    from recheck.operators.match import reconcile
    texts = ["0.0005", "0.0000001", "1000000000000000000", "1125899906842624.2"]
    left = spark.createDataFrame([(i, "k", t) for i, t in enumerate(texts)], "row_id long, k string, t string")
    left = left.withColumn("v", F.col("t").cast("double")).drop("t")
    for kind in ("decimal(38,10)", "string"):
        right = spark.createDataFrame([(i, "k", t) for i, t in enumerate(texts)], "row_id long, k string, v string")
        right = right.withColumn("v", F.col("v").cast(kind))
        got = reconcile(left, right, "k", ["v"]).pairs.select("row_id", "matched_id", "n_diff").collect()
        assert sorted(map(tuple, got)) == [(i, i, 0) for i in range(len(texts))], kind

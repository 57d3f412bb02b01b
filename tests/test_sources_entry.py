"""Scans, sinks and the driver contract."""

import os
import tempfile

import pytest

from recheck.sources import io

SF = "/root/testdata/sf0.001"


def test_read_write_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="recheck-test-", dir="/tmp")
    df = spark.createDataFrame([(1, "f1", 2.5), (2, "f2", None)], "id long, file_name string, p double")
    paths = io.write_results({"a": df}, base, fmt="csv")
    back = io.read_table(spark, paths["a"], schema="id long, file_name string, p double", fmt="csv")
    assert sorted(r.id for r in back.collect()) == [1, 2]
    with pytest.raises(ValueError):
        io.read_table(spark, base + "/x.xlsx")
    part = io.write_partitioned(df, base + "/part", by="file_name", sort=["id"])
    assert sorted(os.listdir(part))[:2] == ["_SUCCESS", "file_name=f1"] or "file_name=f1" in os.listdir(part)
    pre = io.read_prefix(spark, base + "/a", glob="*.csv", schema="id long, file_name string, p double")
    assert all(r.source_file.endswith(".csv") for r in pre.collect())


def test_read_jdbc_arguments(spark):
    with pytest.raises(ValueError):
        io.read_jdbc(spark, "jdbc:none", table="t", query="select 1")
    with pytest.raises(ValueError):
        io.read_jdbc(spark, "jdbc:none", query="select 1", partition_col="id")


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_rules_pass_plans_broadcast(spark):
    import __spark_entry__ as E
    plan = E.queries()["violations_all"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_read_lookup_quoted_commas_crlf(spark):
    base = tempfile.mkdtemp(prefix="recheck-test-", dir="/tmp")
    path = os.path.join(base, "category_suppliers.csv")
    with open(path, "w", newline="") as f:
        f.write('Category_ID,Category_Name,Supplier_ID,Supplier_Name\r\n'
                '81,Cards,28,"Bank, National Association"\r\n'
                '81,Cards,30,Plain Name\r\n')
    df = io.read_lookup(spark, path, schema="Category_ID int, Category_Name string, Supplier_ID long, "
                                            "Supplier_Name string")
    rows = sorted((r.Supplier_ID, r.Supplier_Name) for r in df.collect())
    assert rows == [(28, "Bank, National Association"), (30, "Plain Name")]


def test_to_date_columns(spark):
    from recheck.functions.cells import to_date_columns
    df = spark.sql("SELECT TIMESTAMP'2024-05-06 10:11:12' AS t, 'x' AS s, TIMESTAMP_NTZ'2023-01-02 03:04:05' AS u")
    out = to_date_columns(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["date", "string", "date"]
    assert str(out.first().u) == "2023-01-02"

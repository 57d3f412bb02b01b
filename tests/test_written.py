"""Scans with rejects, files by value with their manifest, decisions in the pass that writes, the literal merge, large
lookups by distinct values, clashing names."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from recheck import flows
from recheck.functions.cells import clean_cells, normalize_dates, write_normalized
from recheck.operators import profile as P
from recheck.operators import rules as RU
from recheck.operators import summary as S
from recheck.sources import io


def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    lines = [f"{i},{'x' if i % 7 == 0 else i / 4},n{i}" + (",extra" if i % 11 == 0 else "") for i in range(2000)]
    lines[5], lines[6], lines[8] = "", "5", '8,2.0,"a, ""b"""'
    files = {"a.csv": lines[:1500], "b.csv": lines[1500:], "c.csv": []}
    for name, own in files.items():
        (tmp_path / name).write_text("\n".join(["id,price,name", *own]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # line numbers hold over splits
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows, rejects = io.read_checked(spark, str(tmp_path), "id long, price double, name string", escape='"')
        got = {(r.file.rsplit("/", 1)[1], r.line): r.record for r in rejects.collect()}
        kept = {r.id: (r.price, r.name) for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    bad = lambda i, x: x and (i == 6 or (i != 8 and (i % 7 == 0 or i % 11 == 0)))
    want = {(f, k + 2): x for f, own in files.items() for k, x in enumerate(own) if bad(lines.index(x), x)}
    assert got == want
    assert kept == {i: (2.0, 'a, "b"') if i == 8 else (i / 4, f"n{i}") for i, x in enumerate(lines) if x and not bad(i, x)}


def test_files_of_a_hot_value_follow_each_other(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 else f"v{i % 9}", rng.choice([None, 1, 2, 3])) for i in range(900)] + [(9999, None, 5)]
    df = spark.createDataFrame(rows, "row_id long, file_name string, total int").repartition(5)
    path = io.write_partitioned(df, str(tmp_path / "out"), sort=["total", "row_id"], rows_per_file=250)
    m = {(r.file_name, r.part): r for r in io.manifest(spark, path, sort=["total", "row_id"]).collect()}
    assert len({r.file for r in m.values()}) == len(m) == len(list((tmp_path / "out").rglob("*.parquet")))
    assert [m["hot", k].rows for k in range(3)] == [250, 250, 100] and m["v0", 0].rows == 100
    assert m[None, 0].rows == 1
    key = lambda r: (r[2] is None, r[2] or 0, r[0])
    hot = sorted((r for r in rows if r[1] == "hot"), key=key)
    for k in range(3):
        part = hot[250 * k: 250 * (k + 1)]
        assert (m["hot", k]["first"].row_id, m["hot", k]["last"].row_id) == (part[0][0], part[-1][0])
    back = spark.read.parquet(path)
    assert sorted((r.row_id, r.file_name, r.total) for r in back.collect()) == sorted(
        [(r[0], r[1], r[2]) for r in rows], key=lambda r: r[0])


def test_a_value_has_one_folder_however_many_files(spark, tmp_path):
    names = ["hot", "hot", "", None, "v"]
    rows = [(i, names[i % 5]) for i in range(2000)]
    df = spark.createDataFrame(rows, "row_id long, file_name string").repartition(4)
    path = io.write_partitioned(df, str(tmp_path / "out"), sort=["row_id"], rows_per_file=30)
    folders = sorted(str(p.relative_to(path)) for p in (tmp_path / "out").rglob("*") if p.is_dir())
    assert folders == ["file_name=__HIVE_DEFAULT_PARTITION__", "file_name=hot", "file_name=v"]  # nothing to list a file
    m = io.manifest(spark, path, sort=["row_id"], more={"sorted": io.in_order(["row_id"])}).collect()
    want = []
    for name in ("hot", None, "v"):  # NULL and '' have one folder
        own = [i for i, n in rows if (n or None) == name]
        want += [(name, k // 30, len(own[k:k + 30]), own[k], own[k:k + 30][-1]) for k in range(0, len(own), 30)]
    key = lambda r: (r[0] or "", r[1])
    assert sorted(((r.file_name, r.part, r.rows, r["first"].row_id, r["last"].row_id) for r in m), key=key) == sorted(want, key=key)
    assert len({r.file for r in m}) == len(m) and all(r.sorted for r in m)
    given = io.manifest(spark, path, schema="row_id long, file_name string", publish=False)
    assert sorted(((r.file_name, r.part, r.rows) for r in given.collect()), key=key) == sorted((w[:3] for w in want), key=key)


def test_order_inside_files(spark, tmp_path):
    for name, values in (("up", [1, 2, 2, 5, None]), ("down", [1, 3, 2]), ("null_first", [None, 1])):
        spark.createDataFrame([(v,) for v in values], "n int").coalesce(1).write.parquet(str(tmp_path / f"out/file_name={name}/part=0"))
    m = io.manifest(spark, str(tmp_path / "out"), sort=["n"], more={"sorted": io.in_order(["n"])})
    assert {r.file_name: r.sorted for r in m.collect()} == {"up": True, "down": False, "null_first": False}


def test_csv_parts_are_folders(spark, tmp_path):
    df = spark.createDataFrame([(i, "f") for i in range(25)], "row_id long, file_name string")
    path = io.write_partitioned(df, str(tmp_path / "out"), sort=["row_id"], rows_per_file=10, fmt="csv")
    m = io.manifest(spark, path, sort=["row_id"], fmt="csv", schema="row_id long").collect()
    assert sorted((r.part, r.rows, r["first"].row_id) for r in m) == [(0, 10, 0), (1, 10, 10), (2, 5, 20)]


def test_dates_are_decided_while_writing(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-01-02", "2020-01-02"), (2, None, "soon"), (3, "2021-03-04 10:00:00", None)],
                               "row_id long, a string, b string")
    got = write_normalized(df, ["a", "b"], str(tmp_path / "x"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, normalize_dates(df, ["a", "b"]).collect()))
    assert got.columns == df.columns
    contract = {"a": "datetime64[ns]", "b": "datetime64[ns]", "c": "int64", "row_id": "int64"}
    df = df.withColumn("c", F.lit(None).cast("string"))
    flagged = P.write_profiled(df, contract, str(tmp_path / "y"))
    assert sorted(map(tuple, flagged.collect())) == sorted(
        (r.category, r.field, r.n_bad) for r in P.flagged_columns(df, contract).collect())
    assert spark.read.parquet(str(tmp_path / "y")).count() == 3


@pytest.mark.parametrize("block", [512, 3])
def test_literal_merge_equals_pandas(spark, block):
    rng = random.Random(3)
    make = lambda n, id0: [(id0 + i, rng.choice(["a", "b", "c", None, f"own{id0}"]), rng.choice([1.5, None])) for i in range(n)]
    a, b = make(40, 0), make(30, 100)
    a += a[:3]
    kind = "row_id long, key string, v double"
    got = S.outer_by_key(spark.createDataFrame(a, kind), spark.createDataFrame(b, kind), "key", block=block)
    cols = ["row_id", "key", "v"]
    left, right = (pd.DataFrame(x, columns=cols) for x in (a, b))
    key = lambda d, s: d["key"].where(d["key"].notna(), s + d["row_id"].astype(str))  # noqa: E731  NULLs meet nothing
    m = left.assign(j=key(left, "l")).merge(right.assign(j=key(right, "r")), on="j", how="outer", suffixes=("_gt", "_pl"))
    plain = lambda v: None if v is None or v != v else float(v) if isinstance(v, (int, float)) else v
    rows = lambda x: sorted((tuple(map(plain, r)) for r in x), key=str)
    assert rows(got.collect()) == rows(m[got.columns].itertuples(index=False))


def test_one_key_of_the_merge_is_spread(spark):
    a = spark.range(3000).select(F.col("id").alias("row_id"), F.lit("k").alias("key"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        m = S.outer_by_key(a, a.withColumn("row_id", F.col("row_id") + 5000), "key")
        sizes = [r["count"] for r in m.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 9_000_000 and max(sizes) < 9_000_000 / 3 and len(sizes) >= 8


def rule_set(spark):
    rng = random.Random(8)
    text = lambda: rng.choice(["a", "B", "c \x01 =", None, "nan", "10"])
    rows = [(i, text(), text(), rng.choice([1, 10, None]), text(), text(), 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id long, sku_normalized string, level5_category string, supplier_id int, "
                                     "supplier_name_original string, sku_original string, unit_price double")
    norm = spark.createDataFrame([("a", "B", "u", "c \x01 =", "yes", 1.0, "no"), ("nan", None, "u", "10", "no", 2.0, "no")],
                                 "normalized_name string, level_5 string, normalized_uom string, original_name string, "
                                 "remove_flag string, price double, price_outlier string")
    alias = spark.createDataFrame([(1, "b"), (10, "A"), (10, "10"), (None, "a"), (1, None)], "supplier_id long, alternative_name string")
    cond = spark.createDataFrame([(1, "A"), (7, "nan")], "supplier_id long, sku_original string")
    return RU.build_rules(df, norm_lookup=norm, supplier_alias=alias, conditional=[cond])


def test_large_lookups_give_the_same_violations(spark):
    rs = rule_set(spark)
    want = sorted(map(tuple, rs.violations().collect()))
    got = rs.violations(max_bytes=0)
    assert sorted(map(tuple, got.collect())) == want
    assert {r[2] for r in want} >= {"R7", "R8", "R11", "R16_missing", "R19"}
    for only in (["R7"], ["R11", "R19"]):
        assert sorted(map(tuple, rs.violations(only=only, max_bytes=0).collect())) == [r for r in want if r[2] in only]


def test_large_lookups_are_one_join_and_no_whole_row_moves(spark):
    rs = rule_set(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rs.violations(only=["R7", "R8", "R11", "R16", "R19"], max_bytes=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2  # values with the sets, violating values with (row, rule, value)
    for line in plan.splitlines():
        assert "Exchange" not in line or "unit_price" not in line


@pytest.mark.parametrize("trim, want", [("both", "a"), ("left", "a\t "), ("none", " \ta\t ")])
def test_clean_cells_trims_as_told(spark, trim, want):
    df = spark.createDataFrame([(" \ta\t ", 1.0, None)], "t string, n double, d date")
    assert tuple(clean_cells(df, trim).first()) == (want, "1", "nan")


def test_unknown_trim(spark):
    with pytest.raises(ValueError, match="unknown trim"):
        clean_cells(spark.range(1), "right")


def test_flows_with_clashing_names(spark, tmp_path):
    kind = "row_id long, sku string, reason string, matched_id string, diff_columns string, pseudo_key string, _at string"
    left = spark.createDataFrame([(1, "a", "r", "m", "d", "p", "l"), (2, "b", "r", "m", "d", "p", "l")], kind)
    right = spark.createDataFrame([(11, "a", "r", "M", "d", "p", "l"), (12, "c", "r", "m", "d", "p", "l")], kind)
    flows.compare(left, right, ["sku"], str(tmp_path))
    got = spark.read.parquet(str(tmp_path / "matched")).first()
    assert (got.matched_id, got._matched_id, got.diff_columns, got._diff_columns) == ("m", 11, "d", "matched_id")
    alone = spark.read.parquet(str(tmp_path / "left_only")).first()
    assert (alone.row_id, alone.reason, alone._reason) == (2, "r", "no_key")
    assert spark.read.parquet(str(tmp_path / "right_only")).first().row_id == 12

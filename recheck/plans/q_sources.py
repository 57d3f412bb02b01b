"""Source/sink queries: category facts, taxonomy lookup, partitioned write and prefix scan round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from recheck.plans.q_profile import flatfile
from recheck.plans.registry import query
from recheck.session import Scratch
from recheck.sources import io
from recheck.sources.fixtures import load_fixture, load_table, with_fixtures

CATEGORY = "category 7"
FACT_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@query("resolve_category", with_fixtures(["taxonomy"], f"SELECT category_name, category_id FROM taxonomy "
                                                      f"WHERE category_name = '{CATEGORY}'"))
def q_resolve_category(spark, sf_dir):
    """Taxonomy row for a category name."""
    return io.resolve_category(load_fixture(spark, sf_dir, "taxonomy"), CATEGORY)


@query("facts_for_category", with_fixtures(["taxonomy"], (
    "SELECT p.p_size AS category_id, " + ", ".join(f"l.{c}" for c in FACT_COLS)
    + f" FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size IN "
      f"(SELECT category_id FROM taxonomy WHERE category_name = '{CATEGORY}')")))
def q_facts_for_category(spark, sf_dir):
    """Price points (lineitem) of the products (part) in one category (J1 with S5)."""
    cat = io.resolve_category(load_fixture(spark, sf_dir, "taxonomy"), CATEGORY)
    facts = load_table(spark, sf_dir, "lineitem").select(*FACT_COLS)
    master = load_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"),
                                                       F.col("p_size").alias("category_id"))
    return io.facts_for_category(facts, master, cat, product_col="l_partkey")


@query("write_partitioned_roundtrip", with_fixtures(["flatfile"], "SELECT row_id, file_name, sku_normalized, "
                                                                  "unit_price FROM flatfile"))
def q_write_partitioned(spark, sf_dir):
    """Flat file written one folder per file name, sorted within, then read back."""
    df = flatfile(spark, sf_dir).select("row_id", "file_name", "sku_normalized", "unit_price")
    path = io.write_partitioned(df, io.scratch_path(spark, "by-file"), by="file_name", sort=["sku_normalized"])
    return spark.read.parquet(path).select("row_id", "file_name", "sku_normalized", "unit_price")


@query("write_manifest", with_fixtures(["flatfile"], (
    "SELECT file_name, CAST(n // 1000 AS INT) AS part, 1 AS files, count(*) AS n_rows, min(row_id) AS first_row, "
    "max(row_id) AS last_row, true AS sorted FROM (SELECT file_name, row_id, row_number() OVER (PARTITION BY file_name "
    "ORDER BY row_id) - 1 AS n FROM flatfile) GROUP BY 1, 2")))
def q_write_manifest(spark, sf_dir):
    """One file for each 1000 rows of a file name, listed in the manifest; rows are sorted in their files."""
    rows = Scratch(spark, "flatfile")
    df = rows.written(flatfile(spark, sf_dir).select("row_id", "file_name", "unit_price"), "rows")
    path = io.write_partitioned(df, f"{io.scratch_path(spark, 'manifest')}/data", sort=["row_id"], rows_per_file=1000)
    rows.drop()
    listed = io.manifest(spark, path, sort=["row_id"], more={"sorted": io.in_order(["row_id"])})
    return listed.groupBy("file_name", "part").agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.sum("rows").alias("n_rows"), F.min("first.row_id").alias("first_row"),
        F.max("last.row_id").alias("last_row"), F.bool_and("sorted").alias("sorted"))


# Lines that do not fit: text for a number, too many cells, too few.
_LINE = ("CASE WHEN o_orderkey % 97 = 0 THEN concat(CAST(o_orderkey AS STRING), ',n/a,', o_orderstatus) "
         "WHEN o_orderkey % 89 = 0 THEN concat(CAST(o_orderkey AS STRING), ',1.5,', o_orderstatus, ',more') "
         "WHEN o_orderkey % 83 = 0 THEN CAST(o_orderkey AS STRING) "
         "ELSE concat(CAST(o_orderkey AS STRING), ',', CAST(o_custkey AS STRING), '.25,', o_orderstatus) END")


@query("scan_with_rejects", (
    f"WITH l AS (SELECT o_orderkey, {_LINE.replace('STRING', 'VARCHAR')} AS line, o_custkey, o_orderstatus, o_orderkey % 97 = 0 OR "
    "o_orderkey % 89 = 0 OR o_orderkey % 83 = 0 AS bad FROM orders) SELECT 'row' AS kind, o_orderkey AS order_id, "
    "o_custkey + 0.25::DOUBLE AS price, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS record FROM l WHERE NOT bad "
    "UNION ALL SELECT 'reject', NULL, NULL, NULL, line FROM l WHERE bad"))
def q_scan_with_rejects(spark, sf_dir):
    """CSV lines of which some do not fit: rows, and every rejected line."""
    path = f"{io.scratch_path(spark, 'lines')}/orders.csv"
    load_table(spark, sf_dir, "orders").selectExpr(f"{_LINE} AS value").write.text(path)
    rows, rejects = io.read_checked(spark, path, "order_id long, price double, status string", header=False)
    return rows.withColumn("kind", F.lit("row")).unionByName(rejects.select(
        F.lit("reject").alias("kind"), "record"), allowMissingColumns=True).select("kind", "order_id", "price", "status", "record")


@query("lookup_scan", with_fixtures(["supplier_alias"], "SELECT alias_id, supplier_id, CASE WHEN alias_id % 3 = 0 THEN "
                                    "concat('a, \"', alternative_name, '\"') ELSE alternative_name END AS alternative_name "
                                    "FROM supplier_alias"))
def q_lookup_scan(spark, sf_dir):
    """A lookup CSV with commas and quotes in its cells, with headers, typed."""
    path = f"{io.scratch_path(spark, 'lookup')}/alias.csv"
    alias = load_fixture(spark, sf_dir, "supplier_alias")
    name = F.when(F.col("alias_id") % 3 == 0, F.concat(F.lit('a, "'), "alternative_name", F.lit('"'))).otherwise(
        F.col("alternative_name"))
    alias.withColumn("alternative_name", name).write.option("header", True).option("escape", '"').csv(path)
    return io.read_lookup(spark, path, "alias_id long, supplier_id long, alternative_name string", escape='"')


@query("prefix_scan", with_fixtures(["gt"], "SELECT row_id, file_name, unit_price FROM gt"))
def q_prefix_scan(spark, sf_dir):
    """Baseline written as CSV files under a prefix, then every matching file read back with its name."""
    gt = load_fixture(spark, sf_dir, "gt").select("row_id", "file_name", "unit_price")
    base = io.scratch_path(spark, "prefix")
    io.write_results({"gt": gt}, base, fmt="csv")
    back = io.read_prefix(spark, base, glob="*.csv", schema="row_id long, file_name string, unit_price double")
    return back.select("row_id", "file_name", "unit_price")


@query("prefix_scan_files", with_fixtures(["gt"], "SELECT file_name AS folder, count(*) AS n_rows FROM gt GROUP BY 1"))
def q_prefix_scan_files(spark, sf_dir):
    """Rows of each folder under a prefix, by the path that the scan gives each row."""
    gt = load_fixture(spark, sf_dir, "gt").select("row_id", "file_name", "unit_price")
    base = io.write_partitioned(gt, io.scratch_path(spark, "folders"), by="file_name", sort=["row_id"], fmt="csv")
    back = io.read_prefix(spark, f"{base}/*", glob="*.csv", schema="row_id long, unit_price double")
    return back.groupBy(F.regexp_extract("source_file", r"file_name=([^/]+)/", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_rows"))

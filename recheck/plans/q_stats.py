"""Price statistics queries over the flat-file fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from recheck.operators import stats as ST
from recheck.operators.order import percentiles, with_position
from recheck.plans.q_profile import flatfile
from recheck.plans.registry import query
from recheck.sources.fixtures import load_fixture, with_fixtures

ROW_COLS = ["row_id", "level5_category", "sku_original", "sku_normalized", "uom", "unit_price", "no_of_price_points",
            "low_price", "percentile_25th", "avg_price", "file_name"]

_F = ("fz", "SELECT * FROM flatfile WHERE unit_price <> 0 OR unit_price IS NULL")


def _stats_sql(offset):
    return (f"SELECT sku_normalized, count(*) - {offset} AS no_of_price_points, min(unit_price) AS low_price, "
            "round(CASE WHEN count(*) FILTER (WHERE unit_price IS NULL) = 0 THEN quantile_cont(unit_price, 0.25) END, 6)"
            " AS percentile_25th, round(avg(unit_price), 6) AS avg_price FROM fz GROUP BY sku_normalized")


def rounded(df):
    """Statistics of doubles agree with the oracle's to six places; the operators don't round."""
    return df.withColumns({c: F.round(c, 6) for c in ("percentile_25th", "avg_price")})


@query("price_stats_per_row", with_fixtures(["flatfile"], "SELECT " + ", ".join(
    f"f.{c}" if c not in ("no_of_price_points", "low_price", "percentile_25th", "avg_price") else f"s.{c}"
    for c in ROW_COLS) + " FROM fz f LEFT JOIN s ON f.sku_normalized = s.sku_normalized", "duckdb",
    extra=[_F, ("s", _stats_sql(1) + " HAVING sku_normalized IS NOT NULL")]))
def q_price_stats_per_row(spark, sf_dir):
    df = ST.drop_zero(flatfile(spark, sf_dir))
    return rounded(ST.price_stats_per_row(df).select(*ROW_COLS))


_BY_NAME = (
    "SELECT f.level5_category, f.uom, s.sku_normalized, "
    + ", ".join(f"CASE WHEN s.sku_normalized IS NOT NULL THEN s.{c} END AS {c}"
                for c in ("no_of_price_points", "low_price", "percentile_25th", "avg_price"))
    + " FROM s JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku_normalized ORDER BY row_id) AS rn "
      "FROM fz) WHERE rn = 1) f ON f.sku_normalized IS NOT DISTINCT FROM s.sku_normalized")


@query("price_stats_by_name", with_fixtures(["flatfile"], _BY_NAME, "duckdb", extra=[_F, ("s", _stats_sql(0))]))
def q_price_stats_by_name(spark, sf_dir):
    df = ST.drop_zero(flatfile(spark, sf_dir))
    return rounded(ST.price_stats_by_name(df))


@query("price_percentile_hot_items", with_fixtures(["flatfile"], (
    "SELECT uom, count(*) AS points, round(quantile_cont(unit_price, 0.25), 6) AS p25, "
    "round(quantile_cont(unit_price, 0.9), 6) AS p90 FROM fz WHERE uom IS NOT NULL AND unit_price IS NOT NULL GROUP BY uom"),
    "duckdb", extra=[_F]))
def q_price_percentile_hot_items(spark, sf_dir):
    """Exact percentiles where three groups hold all rows: by ranks over range partitions."""
    df = ST.drop_zero(flatfile(spark, sf_dir)).select("uom", "unit_price").where("unit_price IS NOT NULL")
    n = df.where("uom IS NOT NULL").groupBy("uom").agg(F.count(F.lit(1)).alias("points"))
    for name, q in (("p25", 0.25), ("p90", 0.9)):
        n = n.join(percentiles(df, "uom", "unit_price", q).select("uom", F.round("percentile", 6).alias(name)), "uom")
    return n


@query("sort_one_column", with_fixtures(["pipeline"], (
    "SELECT row_number() OVER (ORDER BY sku_original ASC NULLS LAST, row_id) AS position, row_id, sku_original "
    "FROM pipeline"), "duckdb"))
def q_sort_one_column(spark, sf_dir):
    """Candidate rows with their places in the order of one column (O1)."""
    return with_position(load_fixture(spark, sf_dir, "pipeline").select("row_id", "sku_original"), ["sku_original"])


@query("sort_two_columns", with_fixtures(["flatfile"], (
    "SELECT row_number() OVER (ORDER BY level5_category ASC NULLS LAST, sku_normalized ASC NULLS LAST) AS position, * "
    f"FROM ({_BY_NAME})"), "duckdb", extra=[_F, ("s", _stats_sql(0))]))
def q_sort_two_columns(spark, sf_dir):
    """Statistics by item as the sorted sheet: category, item (O2)."""
    stats = rounded(ST.price_stats_by_name(ST.drop_zero(flatfile(spark, sf_dir))))
    return with_position(stats, ["level5_category", "sku_normalized"], row_id="sku_normalized")

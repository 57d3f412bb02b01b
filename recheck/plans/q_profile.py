"""Profile and normaliser queries over the flat-file fixture."""

from __future__ import annotations


from pyspark.sql import functions as F

from recheck.functions.cells import clean_cells, clean_sides, lower_strings, nan_to_null, normalize_dates, pseudo_key, write_normalized
from recheck.operators import profile as P
from recheck.plans.registry import query
from recheck.session import Scratch
from recheck.sources.fixtures import load_fixture, with_fixtures

# Schema facts of the flat-file fixture, for the DuckDB side (the Spark side reads them from the DataFrame).
FLATFILE_COLS = ["row_id", "file_name", "sku_original", "sku_normalized", "level5_category", "uom", "supplier_id",
                 "supplier_name_original", "supplier_name_normalized", "client_id", "client_name_original",
                 "quantity", "unit_price", "total_price", "price_date", "payment_term", "price_type", "store_no",
                 "service_frequency"]
FLATFILE_STRINGS = ["file_name", "sku_original", "sku_normalized", "level5_category", "uom",
                    "supplier_name_original", "supplier_name_normalized", "client_name_original", "payment_term",
                    "price_type", "store_no", "service_frequency"]
# The contract fixture as (column, dtype, mandatory, possible values); the oracle SQL is generated from it.
CONTRACT = [("file_name", "object", "Y", None), ("sku_original", "object", "Y", None),
            ("sku_normalized", "object", "Y", None), ("unit_price", "float64", "Y", None),
            ("price_date", "datetime64[ns]", "N", None), ("payment_term", "object", "N", None),
            ("price_type", "object", "N", "A,B"), ("store_no", "int64", "N", None),
            ("service_frequency", "object", "N", None), ("currency_code", "object", "Y", None)]
DUCK_TYPES = {"object": "VARCHAR", "int64": "BIGINT", "float64": "DOUBLE", "datetime64[ns]": "TIMESTAMP"}


def flatfile(spark, sf_dir):
    return nan_to_null(load_fixture(spark, sf_dir, "flatfile"))


def contract(spark, sf_dir):
    return P.contract_rows(load_fixture(spark, sf_dir, "contract"))


def _sql(body, extra=()):
    return with_fixtures(["flatfile", "contract"], body, "duckdb", extra=list(extra))


def _u(parts):
    return " UNION ALL ".join(parts)


_MAND = [c for c, _, m, _ in CONTRACT if m == "Y" and c in FLATFILE_COLS]
MISSING_SQL = _u(
    f"SELECT 'Mandatory Fields' AS category, 'Missing Mandatory Fields' AS sub_category, '{c}' AS field, file_name, "
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100 AS missing_pct "
    f"FROM flatfile WHERE file_name IS NOT NULL GROUP BY file_name HAVING count(*) FILTER (WHERE {c} IS NULL) > 0"
    for c in _MAND)


@query("missing_pct", _sql(MISSING_SQL))
def q_missing_pct(spark, sf_dir):
    rows = contract(spark, sf_dir)
    return P.missing_pct(flatfile(spark, sf_dir), [r[0] for r in rows if r[2] == "Y"])


ALL_NULL_SQL = _u(f"SELECT 'All Null Values' AS category, '{c}' AS field FROM flatfile HAVING count({c}) = 0"
                  for c in FLATFILE_COLS)


@query("all_null_columns", _sql(ALL_NULL_SQL))
def q_all_null_columns(spark, sf_dir):
    return P.all_null_columns(flatfile(spark, sf_dir))


_TYPED = [(c, DUCK_TYPES[t]) for c, t, _, _ in CONTRACT if c in FLATFILE_COLS]
DTYPE_SQL = _u(
    f"SELECT 'Mismatched Data Types' AS category, '{c}' AS field, "
    f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS n_bad FROM flatfile "
    f"HAVING count({c}) > 0 AND count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) > 0"
    for c, t in _TYPED)


@query("dtype_conformance", _sql(DTYPE_SQL))
def q_dtype_conformance(spark, sf_dir):
    rows = contract(spark, sf_dir)
    return P.dtype_conformance(flatfile(spark, sf_dir), {r[0]: r[1] for r in rows})


@query("sort_category_desc", _sql(
    "SELECT row_number() OVER (ORDER BY category DESC, field) AS position, category, field, n_bad FROM ("
    f"SELECT category, field, CAST(NULL AS BIGINT) AS n_bad FROM ({ALL_NULL_SQL}) UNION ALL "
    f"SELECT category, field, n_bad FROM ({DTYPE_SQL}))"))
def q_sort_category_desc(spark, sf_dir):
    """Flagged columns with their places in the sheet, category descending (O3)."""
    return P.flagged_columns(flatfile(spark, sf_dir), {r[0]: r[1] for r in contract(spark, sf_dir)})


_STRUCT = ([("Column Structure", "Missing Columns", c) for c, *_ in CONTRACT if c not in FLATFILE_COLS]
           + [("Column Structure", "Extra Columns", c) for c in FLATFILE_COLS if c not in [r[0] for r in CONTRACT]])
SUMMARY_SQL = _u(
    [f"SELECT '{a}' AS category, '{b}' AS sub_category, '{c}' AS field, CAST(NULL AS VARCHAR) AS file_name, "
     "CAST(NULL AS DOUBLE) AS missing_pct, CAST(NULL AS BIGINT) AS n_bad" for a, b, c in _STRUCT]
    + [f"SELECT category, sub_category, field, file_name, missing_pct, CAST(NULL AS BIGINT) FROM ({MISSING_SQL})"]
    + [f"SELECT category, CAST(NULL AS VARCHAR), field, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), "
       f"CAST(NULL AS BIGINT) FROM ({ALL_NULL_SQL})"]
    + [f"SELECT category, CAST(NULL AS VARCHAR), field, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), n_bad "
       f"FROM ({DTYPE_SQL})"])


@query("validation_summary", _sql(SUMMARY_SQL))
def q_validation_summary(spark, sf_dir):
    return P.validation_summary(spark, flatfile(spark, sf_dir), contract(spark, sf_dir))


@query("normalize_dates", _sql(
    "SELECT row_id, strftime(price_date, '%Y-%m-%d') AS price_date, CASE WHEN (SELECT count(*) FILTER (WHERE "
    "store_no IS NOT NULL AND TRY_CAST(store_no AS TIMESTAMP) IS NULL) FROM flatfile) = 0 THEN "
    "strftime(TRY_CAST(store_no AS TIMESTAMP), '%Y-%m-%d') ELSE store_no END AS store_no FROM flatfile"))
def q_normalize_dates(spark, sf_dir):
    """Dates to text, all or nothing per column: price_date converts, store_no ('n/a' present) stays."""
    df = flatfile(spark, sf_dir).select("row_id", "price_date", "store_no")
    return normalize_dates(df, ["price_date", "store_no"])


@query("normalize_dates_written", _sql(
    "SELECT row_id, strftime(price_date, '%Y-%m-%d') AS price_date, store_no, payment_term FROM flatfile"))
def q_normalize_dates_written(spark, sf_dir):
    """The same decided in the pass that writes: the flat file is read once."""
    df = flatfile(spark, sf_dir).select("row_id", "price_date", "store_no", "payment_term")
    return write_normalized(df, ["price_date", "store_no", "payment_term"], Scratch(spark, "normalized").path)


@query("profile_while_writing", _sql(
    f"SELECT category, field, CAST(NULL AS BIGINT) AS n_bad FROM ({ALL_NULL_SQL}) UNION ALL "
    f"SELECT category, field, n_bad FROM ({DTYPE_SQL})"))
def q_profile_while_writing(spark, sf_dir):
    """All-NULL columns and values of another type than the contract's, counted while the flat file is written (A2, A3)."""
    return P.write_profiled(flatfile(spark, sf_dir), {r[0]: r[1] for r in contract(spark, sf_dir)},
                            Scratch(spark, "profiled").path)


@query("lower_strings", _sql("SELECT row_id, " + ", ".join(f"lower({c}) AS {c}" for c in FLATFILE_STRINGS)
                             + " FROM flatfile"))
def q_lower_strings(spark, sf_dir):
    """Every string cell lower-cased (the string columns and the row id are reported)."""
    return lower_strings(flatfile(spark, sf_dir)).select("row_id", *FLATFILE_STRINGS)


@query("clean_cells", _sql("SELECT row_id, " + ", ".join(f"coalesce(trim({c}), 'nan') AS {c}" for c in FLATFILE_STRINGS)
                           + " FROM flatfile"))
def q_clean_cells(spark, sf_dir):
    df = flatfile(spark, sf_dir)
    return clean_cells(df.select("row_id", *FLATFILE_STRINGS), "both", FLATFILE_STRINGS)


@query("clean_sides", with_fixtures(["gt"], " UNION ALL ".join(
    f"SELECT '{side}' AS side, CAST(row_id AS VARCHAR) AS row_id, {text} AS sku_original, CAST(row_id % 1000 AS VARCHAR) "
    "|| CASE row_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.25' WHEN 2 THEN '.5' ELSE '.75' END AS unit_price, "
    "coalesce(CAST(price_date AS VARCHAR), 'nan') AS price_date, coalesce(payment_term, 'nan') AS payment_term, "
    "CASE WHEN row_id % 5 = 0 THEN 'nan' ELSE CAST(row_id % 7 AS VARCHAR) END AS quantity FROM gt"
    for side, text in (("left", "sku_original"), ("right", "'  ' || sku_original || chr(9)"))), "duckdb"))
def q_clean_sides(spark, sf_dir):
    """Text, numbers, dates and NULLs of both sides as cell text, the left side stripped only (N3, N4); the key first."""
    gt = load_fixture(spark, sf_dir, "gt")
    padded = gt.select(
        F.concat(F.lit("  "), "sku_original", F.lit("\t")).alias("sku_original"),
        (F.col("row_id") % 1000 + (F.col("row_id") % 4) / 4).alias("unit_price"), "price_date", "payment_term",
        F.when(F.col("row_id") % 5 != 0, F.col("row_id") % 7).alias("quantity"), "row_id")
    left, right = clean_sides(padded, padded, "left")
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))


@query("key_first", with_fixtures(["gt"], (
    "SELECT unnest([1, 2, 3, 4]) AS place, unnest(['pseudo_key', 'row_id', 'file_name', 'sku_normalized']) AS \"column\", "
    "count(*) AS n_rows, min(regexp_replace(concat_ws('-', file_name, sku_normalized), '[^A-Za-z0-9]', '', 'g')) AS least_key "
    "FROM gt"), "duckdb"))
def q_key_first(spark, sf_dir):
    """Columns of a keyed table in their order, the key first."""
    keyed = pseudo_key(load_fixture(spark, sf_dir, "gt").select("row_id", "file_name", "sku_normalized"),
                       ["file_name", "sku_normalized"], "ascii_case")
    places = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("place"), F.lit(c).alias("column"))
                                 for i, c in enumerate(keyed.columns)]))
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.min("pseudo_key").alias("least_key")).select(
        places.alias("x"), "n_rows", "least_key").select("x.*", "n_rows", "least_key")


@query("drop_zero", _sql("SELECT row_id, unit_price FROM flatfile WHERE unit_price <> 0 OR unit_price IS NULL"))
def q_drop_zero(spark, sf_dir):
    from recheck.operators.stats import drop_zero
    return drop_zero(flatfile(spark, sf_dir)).select("row_id", "unit_price")

"""Queries over the end-to-end flows, over mixed column types, and over headers in another style."""

from __future__ import annotations

from pyspark.sql import functions as F

from recheck import flows
from recheck.functions.cells import pseudo_key, to_date_columns
from recheck.operators import rules as RU
from recheck.operators.match import reconcile
from recheck.operators.schema import canonical_headers
from recheck.plans.oracle_sql import greedy_ctes, key_sql
from recheck.plans.q_profile import FLATFILE_COLS, contract, flatfile
from recheck.plans.q_recon import KEY_A, KEY_B, PAIRS_BODY, RECON_COLS, _ci_ctes, _exact_ctes, _oracle
from recheck.plans.q_rules import _BAND, LOOKUPS, RULE_SQL, _sql
from recheck.plans.registry import query
from recheck.sources import io
from recheck.sources.fixtures import load_fixture, load_sides, with_fixtures

_SHEET = """SELECT pid AS row_id, matched AS matched_id, array_to_string(diff, ',') AS diff_columns FROM st
 WHERE i > 0 AND matched IS NOT NULL"""


def _sheet(spark, base):
    """The matched sheet as it was written."""
    return spark.read.parquet(f"{base}/matched").select("row_id", "matched_id", "diff_columns")


@query("flow_compare", _oracle(_exact_ctes(), _SHEET))
def q_flow_compare(spark, sf_dir):
    """Pipeline output against the baseline, from alignment to the written comparison sheet."""
    base = io.scratch_path(spark, "compare")
    pl, gt = load_sides(spark, sf_dir)
    flows.compare(pl, gt, KEY_A, base)
    return _sheet(spark, base)


@query("flow_flat_vs_extract", _oracle(_ci_ctes(), _SHEET))
def q_flow_flat_vs_extract(spark, sf_dir):
    """Flat file against a database extract (kept as Parquet), upper-case headers on one side."""
    base = io.scratch_path(spark, "flat-vs-extract")
    pl, extract = load_sides(spark, sf_dir)
    extract.toDF(*[c.upper() if c != "row_id" else c for c in extract.columns]).write.parquet(f"{base}/extract")
    flows.flat_vs_extract(pl, spark.read.parquet(f"{base}/extract"), KEY_B, base)
    return _sheet(spark, base)


# -- the written sheets of a flow as one table ---------------------------------------------------------------------

# Columns of the tagged table: those of whole rows, and of findings.
_ROW = {"row_id": "BIGINT", "file_name": "VARCHAR", "sku_original": "VARCHAR", "sku_normalized": "VARCHAR",
        "level5_category": "VARCHAR", "uom": "VARCHAR", "unit_price": "DOUBLE", "price_date": "VARCHAR",
        "payment_term": "VARCHAR"}
_FOUND = {"matched_id": "BIGINT", "diff_columns": "VARCHAR", "reason": "VARCHAR", "metric": "VARCHAR", "value": "BIGINT",
          "column": "VARCHAR", "side": "VARCHAR", "field": "VARCHAR", "rule": "VARCHAR", "message": "VARCHAR",
          "comment": "VARCHAR"}


def tagged(spark, base, sheets):
    """The named sheets as they were written, one after the other, with the sheet's name."""
    out = None
    for name in sheets:
        part = spark.read.parquet(f"{base}/{name}").withColumn("sheet", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.withColumn("price_date", F.col("price_date").cast("string"))


def _tagged_sql(sheets, columns):
    """``sheets``: (name, the columns that it has, FROM clause) with SQL for each column's value."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS sheet, " + ", ".join(
            f"CAST({own[c]} AS {kind}) AS \"{c}\"" if c in own else f"CAST(NULL AS {kind}) AS \"{c}\"" for c, kind in columns.items())
        + f" FROM {source}" for name, own, source in sheets)


def _comparison_sql(left, right, prefix="", cols=_ROW):
    """The sheets of a comparison, from the greedy's steps (``st``) and both sides."""
    def whole(t):
        return {c: f"{t}.{c}" for c in cols}
    return [
        (f"{prefix}matched", whole("l") | {"matched_id": "st.matched", "diff_columns": "array_to_string(st.diff, ',')"},
         f"st JOIN {left} l ON l.row_id = st.pid WHERE st.i > 0 AND st.matched IS NOT NULL"),
        (f"{prefix}left_only", whole("l") | {
            "reason": "CASE WHEN st.k IN (SELECT k FROM g) THEN 'used_up' ELSE 'no_key' END"},
         f"st JOIN {left} l ON l.row_id = st.pid WHERE st.i > 0 AND st.matched IS NULL"),
        (f"{prefix}right_only", whole("r"),
         f"{right} r WHERE r.row_id NOT IN (SELECT consumed FROM st WHERE i > 0 AND consumed IS NOT NULL)"),
        (f"{prefix}totals", {"metric": "'matched'", "value": "count(*)"}, "st WHERE i > 0 AND matched IS NOT NULL"),
        (f"{prefix}totals", {"metric": "'left_only'", "value": "count(*)"}, "st WHERE i > 0 AND matched IS NULL"),
        (f"{prefix}totals", {"metric": "'right_only'", "value": "count(*)"},
         "g WHERE id NOT IN (SELECT consumed FROM st WHERE consumed IS NOT NULL)")]


def _columns_sql(rows, prefix=""):
    return [(f"{prefix}columns", {"column": f"'{c}'", "side": f"'{s}'"}, "(SELECT 1)") for c, s in rows]


_COMPARED = {c: _FOUND[c] for c in ("matched_id", "diff_columns", "reason", "metric", "value", "column", "side")}


@query("flow_compare_sheets", _oracle(_exact_ctes(), _tagged_sql(
    _comparison_sql("pipeline", "gt") + _columns_sql([("batch_no", "left"), ("approved_by", "right")]), _ROW | _COMPARED)))
def q_flow_compare_sheets(spark, sf_dir):
    """Every sheet of a comparison, whole rows, as written; each side has a column that the other lacks."""
    base = io.scratch_path(spark, "compare")
    pl, gt = load_sides(spark, sf_dir)
    flows.compare(pl.withColumn("batch_no", F.lit(1)), gt.withColumn("approved_by", F.lit("x")), KEY_A, base)
    return tagged(spark, base, ["matched", "left_only", "right_only", "totals", "columns"])


@query("flow_flat_vs_extract_sheets", _oracle(_ci_ctes(), _tagged_sql(_comparison_sql("pipeline", "gt"), _ROW | {
    c: _FOUND[c] for c in ("matched_id", "diff_columns", "reason", "metric", "value")})))
def q_flow_flat_vs_extract_sheets(spark, sf_dir):
    """Every sheet of the database comparison, whole rows, as written."""
    base = io.scratch_path(spark, "flat-vs-extract")
    pl, extract = load_sides(spark, sf_dir)
    extract.toDF(*[c.upper() if c != "row_id" else c for c in extract.columns]).write.parquet(f"{base}/extract")
    flows.flat_vs_extract(pl, spark.read.parquet(f"{base}/extract"), KEY_B, base)
    return tagged(spark, base, ["matched", "left_only", "right_only", "totals"])


# Business checks: line items and price points in one table. Files that the baseline holds are compared with it, rows of
# all other files go through every rule.
_SHIFT = 10 ** 12  # price points' ids, clear of the line items'
_KNOWN = [("known", "SELECT " + ", ".join(_ROW) + " FROM flatfile WHERE file_name IN (SELECT file_name FROM gt) UNION ALL "
           f"SELECT row_id + {_SHIFT}, " + ", ".join(list(_ROW)[1:]) + " FROM pipeline"),
          ("newrows", "SELECT * FROM flatfile WHERE file_name NOT IN (SELECT file_name FROM gt)"), _BAND]
_NEW_RULES = {r: [p.replace("FROM flatfile f", "FROM newrows f") for p in parts] for r, parts in RULE_SQL.items()}
_FINDINGS = [("violations", {c: c for c in ("row_id", "field", "rule", "message")}, f"({p})")
             for parts in _NEW_RULES.values() for p in parts]
_FINDINGS += [
    ("comments", {"row_id": "row_id", "comment": "string_agg(message || ' in ' || field, '; ' ORDER BY pos)"},
     "(" + " UNION ALL ".join(f"SELECT *, {FLATFILE_COLS.index(c) + 1} AS pos FROM ({p})" for p, c in zip(
         _NEW_RULES["R16"], ["supplier_id", "client_id", "supplier_id", "client_id"])) + ") GROUP BY row_id"),
    ("rules_not_run", {"rule": "'R1'", "reason": "'no column currency_code'"}, "(SELECT 1)")]


@query("flow_rules", with_fixtures(["gt", "pipeline", *LOOKUPS], _tagged_sql(
    _FINDINGS + _comparison_sql("known", "gt", "compare_") + _columns_sql(
        [(c, "left") for c in FLATFILE_COLS if c not in _ROW], "compare_"), _ROW | _FOUND), "duckdb", recursive=True,
    extra=_KNOWN + greedy_ctes("known", "gt", key_sql(KEY_A, "ascii_lower"), key_sql(KEY_A, "ascii_lower"), RECON_COLS,
                               list(RECON_COLS), list(RECON_COLS), ["sku_original"], ["sku_original"])))
def q_flow_rules(spark, sf_dir):
    """Business checks with contract and lookups: violations, comments, rules not run, and all sheets of the comparison
    of the files that the baseline holds, as written."""
    base = io.scratch_path(spark, "rules")
    cat, cal = (load_fixture(spark, sf_dir, n) for n in ("supplier_category", "client_alias"))
    pl, gt = load_sides(spark, sf_dir)
    points = pl.withColumn("row_id", F.col("row_id") + _SHIFT)
    flows.business_checks(
        flatfile(spark, sf_dir).unionByName(points, allowMissingColumns=True), gt,
        ["file_name"], KEY_A, base, contract_rows=contract(spark, sf_dir),
        norm_lookup=load_fixture(spark, sf_dir, "norm_lookup"), supplier_category=cat,
        supplier_alias=load_fixture(spark, sf_dir, "supplier_alias"), client_alias=cal, conditional=[cat, cal])
    return tagged(spark, base, ["violations", "comments", "rules_not_run", *[
        f"compare_{s}" for s in ("matched", "left_only", "right_only", "totals", "columns")]])


# -- column types ------------------------------------------------------------------------------------------------
# Large integers with NULLs, doubles, decimals, dates and far timestamps; keys with one and with several rows a side.
_TYPED = """SELECT o_orderkey AS row_id,
 CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 100000000 ELSE o_custkey % 5000 END AS k,
 CASE WHEN o_orderkey % 7 <> 0 THEN CAST(9007199254740992 AS BIGINT) + o_orderkey % 4 {bump} END AS big,
 CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price,
 CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS day,
 CASE WHEN o_orderkey % 5 = 0 THEN CAST('9999-12-31 23:59:59' AS TIMESTAMP)
   ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS seen_at, o_orderkey % 10 AS small
FROM {{orders}}"""
TYPE_COLS = ["big", "price", "amount", "day", "seen_at", "small"]


def _typed_sql(engine, sf_dir=None):
    from recheck.sources.fixtures import table_refs
    refs = table_refs(engine, sf_dir)
    left = _TYPED.format(bump="+ CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END").format(**refs)
    return left, _TYPED.format(bump="").format(**refs)


def _typed(spark, sf_dir):
    left, right = _typed_sql("spark", sf_dir)
    return spark.sql(left).where("row_id % 17 <> 0"), spark.sql(right)


def _types_oracle(cmp_l, cmp_r):
    left, right = _typed_sql("duckdb")
    ctes = [("tl", f"SELECT * FROM ({left}) WHERE row_id % 17 <> 0"), ("tr", right)]
    return with_fixtures([], PAIRS_BODY, "duckdb", recursive=True, extra=ctes + greedy_ctes(
        "tl", "tr", "CAST(k AS VARCHAR)", "CAST(k AS VARCHAR)", TYPE_COLS, cmp_l, cmp_r, [], []))


def _pairs(res):
    return res.pairs.select("row_id", F.col("key").cast("string").alias("key"), "matched_id", "consumed_id",
                            F.col("n_diff").cast("bigint").alias("n_diff"),
                            F.array_join("diff_columns", ",").alias("diff_columns"))


@query("recon_pairs_types", _types_oracle(TYPE_COLS, TYPE_COLS))
def q_recon_pairs_types(spark, sf_dir):
    """Reconciliation over whole numbers beyond 2^53, decimals, dates and year-9999 timestamps, by a BIGINT key."""
    left, right = _typed(spark, sf_dir)
    return _pairs(reconcile(left, right, "k", TYPE_COLS))


@query("recon_pairs_mixed_types", _types_oracle(TYPE_COLS, TYPE_COLS))
def q_recon_pairs_mixed_types(spark, sf_dir):
    """The same with other types on the right side (text, doubles for whole numbers, a wider decimal): equal values
    stay equal."""
    left, right = _typed(spark, sf_dir)
    other = right.withColumns({"big": F.col("big").cast("string"), "small": F.col("small").cast("double"),
                               "amount": F.col("amount").cast("decimal(30,6)"), "day": F.col("day").cast("timestamp")})
    return _pairs(reconcile(left, other, "k", TYPE_COLS))

# Numbers whose text as a double has an exponent, or a place behind the point beyond 1e15; written as text, so that the
# oracle compares texts and only the queries' sides have types.
_NUMBERS = """SELECT o_orderkey AS row_id,
 CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey + 100000000 ELSE o_custkey % 5000 END AS k,
 CASE (o_orderkey {bump}) % 5 WHEN 0 THEN '0.0005' WHEN 1 THEN '0.0000001' WHEN 2 THEN '-0.0003' WHEN 3 THEN '0.009' END AS tiny,
 CASE o_custkey % 3 WHEN 0 THEN '0.0005' WHEN 1 THEN '0.0000001' ELSE '1125899906842624.2' END AS as_text,
 CASE (o_orderkey {bump}) % 3 WHEN 0 THEN '1000000000000000000' WHEN 1 THEN '2000000000000000000' ELSE '-7' END AS huge,
 CASE o_orderkey % 2 WHEN 0 THEN '1125899906842624.2' ELSE '2251799813685248.5' END AS frac
FROM {{orders}}"""
NUMBER_COLS = ["tiny", "as_text", "huge", "frac"]
_BUMP = "+ CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END"


def _numbers_sql(engine, sf_dir=None):
    from recheck.sources.fixtures import table_refs
    refs = table_refs(engine, sf_dir)
    return tuple(_NUMBERS.format(bump=b).format(**refs) for b in (_BUMP, ""))


def _numbers_oracle():
    left, right = _numbers_sql("duckdb")
    ctes = [("tl", f"SELECT * FROM ({left}) WHERE row_id % 17 <> 0"), ("tr", right)]
    return with_fixtures([], PAIRS_BODY, "duckdb", recursive=True, extra=ctes + greedy_ctes(
        "tl", "tr", "CAST(k AS VARCHAR)", "CAST(k AS VARCHAR)", NUMBER_COLS, NUMBER_COLS, NUMBER_COLS, [], []))


@query("recon_pairs_mixed_numbers", _numbers_oracle())
def q_recon_pairs_mixed_numbers(spark, sf_dir):
    """Doubles below 0.01, from 1e18 on and with places beyond 1e15 against decimals, whole numbers and text."""
    left, right = (spark.sql(x) for x in _numbers_sql("spark", sf_dir))
    left = left.where("row_id % 17 <> 0").withColumns({c: F.col(c).cast("double") for c in NUMBER_COLS})
    right = right.withColumns({"tiny": F.col("tiny").cast("decimal(38,10)"), "huge": F.col("huge").cast("bigint"),
                               "frac": F.col("frac").cast("decimal(38,4)")})
    return _pairs(reconcile(left, right, "k", NUMBER_COLS))

# -- headers in another style --------------------------------------------------------------------------------------


def _title(c):
    return "_".join(x.capitalize() for x in c.split("_"))


@query("violations_title_headers", _sql(
    "SELECT row_id, CASE field " + " ".join(f"WHEN '{c}' THEN '{_title(c)}'" for c in FLATFILE_COLS)
    + " END AS field, rule, message FROM (" + " UNION ALL ".join(p for parts in RULE_SQL.values() for p in parts) + ")",
    [_BAND]))
def q_violations_title_headers(spark, sf_dir):
    """Every rule over headers such as Price_Date: names resolve by their canonical form (C4)."""
    cat, cal = (load_fixture(spark, sf_dir, n) for n in ("supplier_category", "client_alias"))
    df = flatfile(spark, sf_dir)
    df = df.toDF(*[c if c == "row_id" else _title(c) for c in df.columns])
    return RU.build_rules(df, contract(spark, sf_dir), norm_lookup=load_fixture(spark, sf_dir, "norm_lookup"),
                          supplier_category=cat, supplier_alias=load_fixture(spark, sf_dir, "supplier_alias"),
                          client_alias=cal, conditional=[cat, cal]).violations()


@query("rule_R8_pooled", _sql(
    f"SELECT row_id, 'level5_category' AS field, 'R8' AS rule, '{RU.MESSAGES['R8']}' AS message FROM flatfile f WHERE "
    "NOT EXISTS (SELECT 1 FROM norm_lookup l WHERE l.level_5 IS NOT DISTINCT FROM f.level5_category "
    "OR l.normalized_name IS NOT DISTINCT FROM f.level5_category)"))
def q_rule_r8_pooled(spark, sf_dir):
    """Level 5 against the pooled values of two lookup columns."""
    return RU.build_rules(flatfile(spark, sf_dir), contract(spark, sf_dir), norm_lookup=load_fixture(
        spark, sf_dir, "norm_lookup"), level5_pool=["normalized_name"]).violations(only=["R8"])

# -- keys, headers, dates --------------------------------------------------------------------------------------------


def _key_query(variant):
    def fn(spark, sf_dir):
        return pseudo_key(load_fixture(spark, sf_dir, "gt"), KEY_A, variant).select("pseudo_key", "row_id")
    fn.__doc__ = f"Row keys, variant {variant} (K1-K3)."
    return fn


for _name, _variant in (("a", "ascii_lower"), ("b", "ascii_case"), ("c", "unicode_lower")):
    query(f"key_variant_{_name}", with_fixtures(["gt"], f"SELECT {key_sql(KEY_A, _variant)} AS pseudo_key, row_id FROM gt"))(
        _key_query(_variant))


@query("canonical_headers", with_fixtures(["gt"], "SELECT row_id AS rowid, file_name AS filename, unit_price AS unitprice, "
                                                  "CAST(price_date AS VARCHAR) AS pricedate FROM gt"))
def q_canonical_headers(spark, sf_dir):
    """Headers such as 'Unit Price' brought to their canonical names (C4)."""
    gt = load_fixture(spark, sf_dir, "gt").select("row_id", "file_name", "unit_price", F.col("price_date").cast("string"))
    return canonical_headers(gt.toDF("Row ID", "FILE_NAME", "Unit Price", "Price-Date"))


@query("to_date_columns", with_fixtures([], "SELECT o_orderkey AS row_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS at FROM "
                                           "orders"))
def q_to_date_columns(spark, sf_dir):
    """Timestamps truncated to dates."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    at = (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL '13' HOUR")).alias("at")
    out = to_date_columns(orders.select(F.col("o_orderkey").alias("row_id"), at))
    return out.select("row_id", F.col("at").cast("string").alias("at"))

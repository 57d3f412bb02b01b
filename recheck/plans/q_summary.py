"""Summary queries over the reconciliation fixtures."""

from __future__ import annotations


from pyspark.sql import functions as F

from recheck.functions.cells import clean_key_text, nan_to_null, pseudo_key
from recheck.operators import summary as S
from recheck.operators.match import RIGHT
from recheck.plans.oracle_sql import key_sql
from recheck.plans.q_recon import KEY_B, RECON_COLS, _exact_ctes, recon_exact
from recheck.plans.registry import query
from recheck.sources.fixtures import load_fixture, load_sides, with_fixtures

# Columns checked per file in the key outer merge (the key columns themselves are not re-checked).
SUM_COLS = ["sku_original", "sku_normalized", "level5_category", "uom", "unit_price", "price_date", "payment_term"]
PK_COLS = ["file_name", "sku_original"]
ALL_COLS = ["file_name"] + SUM_COLS  # fixture columns without the row id


def keyed_sides(spark, sf_dir):
    """Both sides with SKU text cleaned and primary key C (file, SKU) put first."""
    return _keyed(*reversed(load_sides(spark, sf_dir)))


def _keyed(gt, pl):
    out = []
    for df in (nan_to_null(gt), nan_to_null(pl)):
        df = df.withColumn("sku_original", clean_key_text("sku_original"))
        out.append(pseudo_key(df, PK_COLS, "unicode_lower", name="primary_key"))
    return out


# -- DuckDB side --------------------------------------------------------------------------------------------------
_KEYED = [
    ("g2", "SELECT * REPLACE (lower(regexp_replace(sku_original, '[^A-Za-z0-9]', '', 'g')) AS sku_original) FROM gt"),
    ("p2", "SELECT * REPLACE (lower(regexp_replace(sku_original, '[^A-Za-z0-9]', '', 'g')) AS sku_original) FROM pipeline"),
    ("gk", f"SELECT {key_sql(PK_COLS, 'unicode_lower')} AS primary_key, * FROM g2"),
    ("pk", f"SELECT {key_sql(PK_COLS, 'unicode_lower')} AS primary_key, * FROM p2"),
    ("m", "SELECT " + ", ".join([f"gk.{c} AS {c}_gt" for c in ["primary_key", "row_id"] + ALL_COLS]
                                + [f"pk.{c} AS {c}_pl" for c in ["primary_key", "row_id"] + ALL_COLS])
     + " FROM gk FULL OUTER JOIN pk ON gk.primary_key = pk.primary_key"),
]


def _sql(body, extra=()):
    return with_fixtures(["gt", "pipeline"], body, "duckdb", extra=list(_KEYED) + list(extra))


def _rsql(body, extra=()):
    return with_fixtures(["gt", "pipeline"], body, "duckdb", extra=_exact_ctes() + list(extra), recursive=True)


def _union_fields(tmpl, cols):
    return " UNION ALL ".join(tmpl.format(c=c) for c in cols)


@query("recon_outer_by_key", _sql(
    "SELECT coalesce(primary_key_gt, primary_key_pl) AS key, count(DISTINCT row_id_gt) AS gt_rows, "
    "count(DISTINCT row_id_pl) AS pl_rows, count(*) AS merged_rows FROM m GROUP BY 1"))
def q_outer_by_key(spark, sf_dir):
    """Shape of the key outer merge per key (J4): baseline rows, candidate rows, merged rows -- without emitting
    the n*m merged pairs (``summary.outer_by_key`` builds the literal merge for bounded inspection)."""
    gt, pl = keyed_sides(spark, sf_dir)
    return S.merge_profile(gt, pl, "primary_key")


_M_COLS = [f"{c}{x}" for x in ("_gt", "_pl") for c in ["primary_key", "row_id"] + ALL_COLS]


@query("recon_outer_rows", _sql("SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c.startswith("price_date") else c for c in _M_COLS) + " FROM m"))
def q_outer_rows(spark, sf_dir):
    """Every row of the key outer merge, columns suffixed."""
    gt, pl = keyed_sides(spark, sf_dir)
    m = S.outer_by_key(gt.select("primary_key", "row_id", *ALL_COLS), pl.select("primary_key", "row_id", *ALL_COLS),
                       "primary_key")
    return m.withColumns({c: F.col(c).cast("string") for c in ("price_date_gt", "price_date_pl")})


@query("mark_duplicates", _sql(
    "SELECT row_id, count(*) OVER (PARTITION BY file_name, sku_normalized, uom) > 1 AS has_copy FROM pipeline"))
def q_mark_duplicates(spark, sf_dir):
    """Each candidate row: has another row the same file, item and unit."""
    pl = load_fixture(spark, sf_dir, "pipeline")
    return S.mark_duplicates(pl, ["file_name", "sku_normalized", "uom"]).select("row_id", "has_copy")


@query("rows_per_file", _sql("SELECT file_name, count(*) AS total_rows FROM gt WHERE file_name IS NOT NULL GROUP BY 1"))
def q_rows_per_file(spark, sf_dir):
    gt, _ = keyed_sides(spark, sf_dir)
    return S.rows_per_file(gt)


MISSING_SQL = ("SELECT file_name, count(*) FILTER (WHERE primary_key NOT IN (SELECT primary_key FROM pk)) AS missing_rows "
               "FROM gk WHERE file_name IS NOT NULL GROUP BY 1")
EXTRA_SQL = ("SELECT file_name, count(*) FILTER (WHERE primary_key NOT IN (SELECT primary_key FROM gk)) AS extra_rows "
             "FROM pk WHERE file_name IS NOT NULL GROUP BY 1")


@query("missing_per_file", _sql(MISSING_SQL))
def q_missing_per_file(spark, sf_dir):
    gt, pl = keyed_sides(spark, sf_dir)
    return S.missing_per_file(gt, pl, "primary_key")


@query("extra_per_file", _sql(EXTRA_SQL))
def q_extra_per_file(spark, sf_dir):
    gt, pl = keyed_sides(spark, sf_dir)
    return S.extra_per_file(gt, pl, "primary_key")


DUP_COLS = ([f"{c}_gt" for c in ["primary_key"] + ALL_COLS] + [f"{c}_pl" for c in ["primary_key"] + ALL_COLS])
SIDE_COLS = (["primary_key"] + ALL_COLS, ["primary_key"] + ALL_COLS)  # columns of each side in a merged row


@query("duplicate_rows", _sql(
    "SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM m GROUP BY "
    + ", ".join(DUP_COLS) + " HAVING count(*) > 1)"))
def q_duplicate_rows(spark, sf_dir):
    """Merged rows with at least one exact copy (ids excluded)."""
    gt, pl = keyed_sides(spark, sf_dir)
    return S.merge_duplicate_rows(gt, pl, "primary_key", *SIDE_COLS)


@query("mismatch_counts", _sql(_union_fields(
    "SELECT file_name_gt AS file_name, '{c}' AS field, count(*) FILTER (WHERE {c}_gt IS DISTINCT FROM {c}_pl) "
    "AS mismatches FROM m WHERE file_name_gt IS NOT NULL GROUP BY 1", SUM_COLS)))
def q_mismatch_counts(spark, sf_dir):
    gt, pl = keyed_sides(spark, sf_dir)
    return S.key_mismatch_counts(gt, pl, "primary_key", SUM_COLS)


_FILE_TABLE_CTES = [
    ("ft_total", "SELECT file_name, count(*) AS total_rows FROM gk WHERE file_name IS NOT NULL GROUP BY 1"),
    ("ft_miss", MISSING_SQL), ("ft_extra", EXTRA_SQL),
    ("ft_dup", "SELECT file_name_gt AS file_name, CAST(sum(n) AS BIGINT) AS duplicate_rows FROM (SELECT "
     + ", ".join(DUP_COLS) + ", count(*) AS n FROM m GROUP BY ALL HAVING count(*) > 1) GROUP BY 1"),
    ("ft_mm", "SELECT file_name_gt AS file_name, "
     + ", ".join(f"count(*) FILTER (WHERE {c}_gt IS DISTINCT FROM {c}_pl) AS {c}" for c in SUM_COLS)
     + " FROM m WHERE file_name_gt IS NOT NULL GROUP BY 1"),
    ("ft", "SELECT t.file_name, t.total_rows, coalesce(a.missing_rows, 0) AS missing_rows, "
     "coalesce(b.extra_rows, 0) AS extra_rows, coalesce(d.duplicate_rows, 0) AS duplicate_rows, "
     + ", ".join(f"mm.{c}" for c in SUM_COLS)
     + " FROM ft_total t LEFT JOIN ft_miss a USING (file_name) LEFT JOIN ft_extra b USING (file_name) "
       "LEFT JOIN ft_dup d USING (file_name) LEFT JOIN ft_mm mm USING (file_name)"),
]


def measures(spark, sf_dir, complete=False):
    raw = load_sides(spark, sf_dir)
    gt, pl = _keyed(*reversed(raw))
    return S.file_measures(gt, pl, "primary_key", SUM_COLS, dup_cols=SIDE_COLS,
                           complete=(*map(nan_to_null, raw), ALL_COLS) if complete else None)


@query("file_level_accuracy", _sql("SELECT * FROM ft", _FILE_TABLE_CTES))
def q_file_level_accuracy(spark, sf_dir):
    """Per GT file: rows, missing, extra, duplicate rows and mismatches per column (key outer merge)."""
    return S.file_table(measures(spark, sf_dir), SUM_COLS)


# The literal NULL-safe outer merge on all common columns (the Spark side never builds it).
_COMPLETE = [("om", "SELECT " + ", ".join(f"coalesce(a.{c}, b.{c}) AS {c}" for c in ALL_COLS)
              + " FROM (SELECT " + ", ".join(ALL_COLS) + " FROM pipeline) a FULL OUTER JOIN (SELECT "
              + ", ".join(ALL_COLS) + " FROM gt) b ON "
              + " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ALL_COLS)),
             ("oc", _union_fields("SELECT '{c}' AS field, 100 - round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"
                                  " / CAST(count(*) AS DOUBLE) * 100, 2) AS match_pct FROM om", ALL_COLS))]


def completeness(spark, sf_dir):
    gt = nan_to_null(load_fixture(spark, sf_dir, "gt"))
    pl = nan_to_null(load_fixture(spark, sf_dir, "pipeline"))
    return S.outer_completeness(pl, gt, ALL_COLS)


@query("outer_completeness", _sql("SELECT * FROM oc", _COMPLETE))
def q_outer_completeness(spark, sf_dir):
    return completeness(spark, sf_dir)


_ISSUE_SQL = (
    "SELECT u.issue_type, CASE WHEN u.issue_type IN ('missing_rows', 'extra_rows', 'duplicate_rows') THEN 'File' "
    "ELSE 'Field' END AS issue_level, round(100.0 - CAST(sum(u.errors) AS DOUBLE) / CAST(sum(u.total_rows) AS DOUBLE)"
    " * 100, 2) AS accuracy, count(*) FILTER (WHERE u.errors > 0) AS files_affected, CAST(0.0 AS DOUBLE) AS pct_missing, "
    "any_value(i.pct_incorrect) AS pct_incorrect FROM (UNPIVOT (SELECT file_name, total_rows, "
    + ", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in list(S.FILE_LEVEL_ISSUES) + SUM_COLS)
    + " FROM ft) ON " + ", ".join(list(S.FILE_LEVEL_ISSUES) + SUM_COLS)
    + " INTO NAME issue_type VALUE errors) u LEFT JOIN (SELECT field AS issue_type, match_pct AS pct_incorrect FROM oc "
    "UNION ALL SELECT 'duplicate_rows', CAST(coalesce(sum(n), 0) AS DOUBLE) FROM (SELECT count(*) AS n FROM m GROUP BY "
    + ", ".join(DUP_COLS) + " HAVING count(*) > 1)) i ON i.issue_type = u.issue_type GROUP BY u.issue_type")


@query("issue_summary", _sql(_ISSUE_SQL, _FILE_TABLE_CTES + _COMPLETE))
def q_issue_summary(spark, sf_dir):
    return S.issue_table(measures(spark, sf_dir, complete=True), SUM_COLS)


# -- summaries of the greedy pairs (first entry point) --------------------------------------------------------------

def pairs_with_file(spark, sf_dir):
    res = recon_exact(spark, sf_dir, carry=["file_name"])
    return res, res.with_left(res.pairs, ["file_name"])


_PF = [("pf", "SELECT st.diff, pl.file_name FROM st JOIN pipeline pl ON pl.row_id = st.pid "
              "WHERE st.i > 0 AND st.matched IS NOT NULL"),
       ("dc", _union_fields("SELECT file_name, '{c}' AS field, count(*) FILTER (WHERE list_contains(diff, '{c}')) "
                            "AS diffs, count(*) AS total_rows FROM pf GROUP BY 1", RECON_COLS))]


@query("diff_counts_by_file", _rsql("SELECT file_name, field, diffs FROM dc", _PF))
def q_diff_counts_by_file(spark, sf_dir):
    _, p = pairs_with_file(spark, sf_dir)
    return S.diff_counts_by_file(p, RECON_COLS)


@query("diff_totals", _rsql("SELECT field, CAST(sum(diffs) AS BIGINT) AS diffs FROM dc GROUP BY 1", _PF))
def q_diff_totals(spark, sf_dir):
    _, p = pairs_with_file(spark, sf_dir)
    return S.diff_totals(S.diff_counts_by_file(p, RECON_COLS))


@query("category_accuracy", _rsql(
    "SELECT field, round(CAST(sum(total_rows) - sum(diffs) AS DOUBLE) / CAST(sum(total_rows) AS DOUBLE) * 100, 2) "
    "AS accuracy, count(*) FILTER (WHERE diffs <> 0) AS files_affected FROM dc GROUP BY 1", _PF))
def q_category_accuracy(spark, sf_dir):
    _, p = pairs_with_file(spark, sf_dir)
    return S.category_accuracy(p, RECON_COLS)


@query("file_accuracy_table", _rsql(
    "SELECT file_name, count(*) AS total_rows, "
    + ", ".join(f"count(*) FILTER (WHERE list_contains(diff, '{c}')) AS {c}_diffs" for c in RECON_COLS)
    + " FROM pf GROUP BY 1", _PF))
def q_file_accuracy_table(spark, sf_dir):
    _, p = pairs_with_file(spark, sf_dir)
    return S.pair_diff_counts(p, RECON_COLS)


@query("run_totals", _rsql(
    "SELECT 'matched' AS metric, count(*) AS value FROM st WHERE i > 0 AND matched IS NOT NULL UNION ALL "
    "SELECT 'left_only', count(*) FROM st WHERE i > 0 AND matched IS NULL UNION ALL "
    "SELECT 'right_only', count(*) FROM g WHERE id NOT IN (SELECT consumed FROM st WHERE consumed IS NOT NULL)"))
def q_run_totals(spark, sf_dir):
    res = recon_exact(spark, sf_dir)
    return S.run_totals(res.state, res.routed.where(F.col("_side") == RIGHT))


_KB = key_sql(KEY_B, "ascii_case")


@query("key_quality", _sql(
    f"SELECT 'left' AS side, k AS key, count(*) AS n, (k IS NULL OR trim(k) = '') AS is_blank FROM "
    f"(SELECT {_KB} AS k FROM pipeline) GROUP BY k HAVING count(*) > 1 OR k IS NULL OR trim(k) = '' UNION ALL "
    f"SELECT 'right', k, count(*), (k IS NULL OR trim(k) = '') FROM (SELECT {_KB} AS k FROM gt) GROUP BY k "
    f"HAVING count(*) > 1 OR k IS NULL OR trim(k) = ''"))
def q_key_quality(spark, sf_dir):
    gt = pseudo_key(load_fixture(spark, sf_dir, "gt"), KEY_B, "ascii_case")
    pl = pseudo_key(load_fixture(spark, sf_dir, "pipeline"), KEY_B, "ascii_case")
    return S.key_quality(pl, "pseudo_key", "left").unionByName(S.key_quality(gt, "pseudo_key", "right"))


@query("heavy_keys", _sql(
    "SELECT k AS key, count(*) AS n FROM (SELECT sku_normalized AS k FROM pipeline) WHERE k IS NOT NULL GROUP BY k "
    "HAVING count(*) > 0.008 * (SELECT count(sku_normalized) FROM pipeline)"))
def q_heavy_keys(spark, sf_dir):
    """Items that hold more than 0.8 % of the candidate rows each (K4 for keys too many to count one by one)."""
    return S.heavy_keys(load_fixture(spark, sf_dir, "pipeline"), "sku_normalized", 0.008)


@query("baseline_coverage", _sql(
    "SELECT p.file_name, p.level5_category, (g.file_name IS NOT NULL) AS has_baseline FROM "
    "(SELECT DISTINCT file_name, level5_category FROM pipeline) p LEFT JOIN "
    "(SELECT DISTINCT file_name, level5_category FROM gt) g "
    "ON p.file_name IS NOT DISTINCT FROM g.file_name AND p.level5_category IS NOT DISTINCT FROM g.level5_category"))
def q_baseline_coverage(spark, sf_dir):
    gt = load_fixture(spark, sf_dir, "gt")
    pl = load_fixture(spark, sf_dir, "pipeline")
    return S.baseline_coverage(pl, gt, ["file_name", "level5_category"])

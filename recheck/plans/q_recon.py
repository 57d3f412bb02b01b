"""Reconciliation queries: greedy pairs, left/right-only rows, cell diffs."""

from __future__ import annotations

from pyspark.sql import functions as F

from recheck.functions.cells import nan_to_null, pseudo_key
from recheck.operators.match import reconcile
from recheck.plans.oracle_sql import greedy_ctes, key_sql, nz_text
from recheck.plans.registry import query
from recheck.sources.fixtures import load_sides, with_fixtures

# Compared columns of the price-point fixture, in file order (the key and row id are not compared).
RECON_COLS = ["file_name", "sku_original", "sku_normalized", "level5_category", "uom", "unit_price", "price_date",
              "payment_term"]
KEY_A = ["sku_original", "file_name", "uom"]      # pseudo key A (pipeline vs ground truth)
KEY_B = ["file_name", "sku_normalized"]           # pseudo key B (flat file vs database)
CI_COLS = sorted(RECON_COLS)                      # database variant: lower-cased names, alphabetical order


def _sides(spark, sf_dir):
    pl, gt = load_sides(spark, sf_dir)
    return nan_to_null(pl), nan_to_null(gt)


def recon_exact(spark, sf_dir, fast_paths=True, carry=()):
    pl, gt = _sides(spark, sf_dir)
    pl = pseudo_key(pl, KEY_A, "ascii_lower")
    gt = pseudo_key(gt, KEY_A, "ascii_lower")
    return reconcile(pl, gt, "pseudo_key", RECON_COLS, order_by=["sku_original"], fast_paths=fast_paths,
                     carry=carry, rescan=True)


def recon_ci(spark, sf_dir, consume_exact=True, fast_paths=True):
    pl, gt = _sides(spark, sf_dir)
    pl = pseudo_key(pl, KEY_B, "ascii_case")
    gt = pseudo_key(gt, KEY_B, "ascii_case")
    return reconcile(pl, gt, "pseudo_key", CI_COLS, order_by=["file_name"], mode="ci", trim_left=True,
                     consume_exact=consume_exact, fast_paths=fast_paths, rescan=True)


KEY_HOT = ["sku_normalized"]  # few keys of many rows on both sides


def recon_hot(spark, sf_dir):
    """Every n x m key takes the path for hot keys: their comparisons are dealt to tasks."""
    pl, gt = _sides(spark, sf_dir)
    pl, gt = pseudo_key(pl, KEY_HOT, "ascii_lower"), pseudo_key(gt, KEY_HOT, "ascii_lower")
    return reconcile(pl, gt, "pseudo_key", RECON_COLS, order_by=["sku_original"], hot_pairs=0, rescan=True)


def _pairs_out(res):
    p = res.pairs
    return p.select("row_id", "key", "matched_id", "consumed_id", F.col("n_diff").cast("bigint").alias("n_diff"),
                    F.array_join("diff_columns", ",").alias("diff_columns"))


# -- oracle text -------------------------------------------------------------------------------------------------

def _exact_ctes():
    cmp = list(RECON_COLS)
    return greedy_ctes("pipeline", "gt", key_sql(KEY_A, "ascii_lower"), key_sql(KEY_A, "ascii_lower"), RECON_COLS,
                       cmp, cmp, ["sku_original"], ["sku_original"])


def _ci_ctes():
    def txt(c, trim):
        v = f"trim({c})" if trim and c not in ("unit_price", "price_date") else c
        return f"lower({nz_text(v)})"
    return greedy_ctes("pipeline", "gt", key_sql(KEY_B, "ascii_case"), key_sql(KEY_B, "ascii_case"), CI_COLS,
                       [txt(c, True) for c in CI_COLS], [txt(c, False) for c in CI_COLS], ["file_name"], ["file_name"])


def _ci_parity_ctes():
    def txt(c, trim):
        v = f"trim({c})" if trim and c not in ("unit_price", "price_date") else c
        return f"lower({nz_text(v)})"

    def raw(c, trim):
        return f"CAST(trim({c}) AS VARCHAR)" if trim and c not in ("unit_price", "price_date") else f"CAST({c} AS VARCHAR)"
    return greedy_ctes("pipeline", "gt", key_sql(KEY_B, "ascii_case"), key_sql(KEY_B, "ascii_case"), CI_COLS,
                       [txt(c, True) for c in CI_COLS], [txt(c, False) for c in CI_COLS], ["file_name"], ["file_name"],
                       [raw(c, True) for c in CI_COLS], [raw(c, False) for c in CI_COLS])


PAIRS_BODY = """SELECT pid AS row_id, k AS key, matched AS matched_id, consumed AS consumed_id,
 CAST(len(diff) AS BIGINT) AS n_diff, array_to_string(diff, ',') AS diff_columns FROM st WHERE i > 0 AND matched IS NOT NULL"""
LEFT_BODY = """SELECT pid AS row_id, k AS key,
 CASE WHEN k IN (SELECT k FROM g) THEN 'used_up' ELSE 'no_key' END AS reason FROM st WHERE i > 0 AND matched IS NULL"""
RIGHT_BODY = """SELECT id AS row_id, k AS key FROM g
 WHERE id NOT IN (SELECT consumed FROM st WHERE i > 0 AND consumed IS NOT NULL)"""


def _oracle(ctes, body):
    return with_fixtures(["gt", "pipeline"], body, "duckdb", extra=ctes, recursive=True)


@query("recon_pairs", _oracle(_exact_ctes(), PAIRS_BODY))
def q_recon_pairs(spark, sf_dir):
    """Matched pairs of the greedy reconciliation, exact compare (flagship)."""
    return _pairs_out(recon_exact(spark, sf_dir))


def _hot_ctes():
    return greedy_ctes("pipeline", "gt", key_sql(KEY_HOT, "ascii_lower"), key_sql(KEY_HOT, "ascii_lower"), RECON_COLS,
                       list(RECON_COLS), list(RECON_COLS), ["sku_original"], ["sku_original"])


@query("recon_pairs_hot_keys", _oracle(_hot_ctes(), PAIRS_BODY))
def q_recon_pairs_hot_keys(spark, sf_dir):
    """Matched pairs where a few keys hold all rows of both sides."""
    return _pairs_out(recon_hot(spark, sf_dir))


@query("recon_left_only", _oracle(_exact_ctes(), LEFT_BODY))
def q_recon_left_only(spark, sf_dir):
    return recon_exact(spark, sf_dir).left_only


@query("recon_right_only", _oracle(_exact_ctes(), RIGHT_BODY))
def q_recon_right_only(spark, sf_dir):
    return recon_exact(spark, sf_dir).right_only


@query("recon_pairs_ci", _oracle(_ci_ctes(), PAIRS_BODY))
def q_recon_pairs_ci(spark, sf_dir):
    """Database variant: key B, case-insensitive text compare, left side trimmed."""
    return _pairs_out(recon_ci(spark, sf_dir))


@query("recon_pairs_ci_parity", _oracle(_ci_parity_ctes(), PAIRS_BODY))
def q_recon_pairs_ci_parity(spark, sf_dir):
    """Database variant with ``consume_exact=False``: a sole remaining, exactly equal candidate is not consumed."""
    return _pairs_out(recon_ci(spark, sf_dir, consume_exact=False))


@query("recon_right_only_ci_parity", _oracle(_ci_parity_ctes(), RIGHT_BODY))
def q_recon_right_only_ci_parity(spark, sf_dir):
    return recon_ci(spark, sf_dir, consume_exact=False).right_only


@query("recon_left_only_ci", _oracle(_ci_ctes(), LEFT_BODY))
def q_recon_left_only_ci(spark, sf_dir):
    return recon_ci(spark, sf_dir).left_only


@query("recon_right_only_ci", _oracle(_ci_ctes(), RIGHT_BODY))
def q_recon_right_only_ci(spark, sf_dir):
    return recon_ci(spark, sf_dir).right_only


def _cell_text_sql(prefix, c):
    return f"coalesce(CAST({prefix}.{c} AS VARCHAR), 'nan')"


CELL_DIFFS_BODY = (
    "SELECT x.row_id, x.matched_id, x.col AS \"column\", CASE x.col "
    + " ".join(f"WHEN '{c}' THEN {_cell_text_sql('pl', c)}" for c in RECON_COLS)
    + " END AS left_value, CASE x.col "
    + " ".join(f"WHEN '{c}' THEN {_cell_text_sql('gr', c)}" for c in RECON_COLS)
    + " END AS right_value FROM (SELECT pid AS row_id, matched AS matched_id, unnest(diff) AS col FROM st "
      "WHERE i > 0 AND matched IS NOT NULL) x JOIN pipeline pl ON pl.row_id = x.row_id "
      "JOIN gt gr ON gr.row_id = x.matched_id")


@query("recon_cell_diffs", _oracle(_exact_ctes(), CELL_DIFFS_BODY))
def q_recon_cell_diffs(spark, sf_dir):
    return recon_exact(spark, sf_dir).cell_diffs()

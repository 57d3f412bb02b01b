"""The end-to-end flows: pipeline output against a baseline, flat file against a database extract, business checks.

Each takes DataFrames, runs the operators in order, writes one dataset per result to ``base`` and returns the results
by name. Nothing is collected besides column names. Inputs are derived once: the aligned sides (for the business checks:
the data) are written to the shared folder, and the matching and every sheet read them there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recheck.functions.cells import nan_to_null, pseudo_key, to_date_columns
from recheck.operators import summary as S
from recheck.operators.match import RIGHT, ReconcileResult, reconcile
from recheck.operators.rules import build_rules, row_comments
from recheck.operators.schema import align, schema_diff
from recheck.session import Scratch
from recheck.sources.io import write_results


def fresh(name: str, *tables: DataFrame) -> str:
    """``name``, with underscores before it until no column of the tables has it."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def kept(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides written once, for all that reads them."""
    scratch = Scratch(left.sparkSession, "sides")
    return scratch.written(left, "left"), scratch.written(right, "right")


def comparison_sheets(res: ReconcileResult, left: DataFrame, right: DataFrame, row_id: str = "row_id",
                      right_row_id: str = "row_id") -> dict[str, DataFrame]:
    """The three sheets of a comparison (D2): matched left rows with their baseline row and differing columns, left rows
    without a baseline row, baseline rows left over; each row whole. A finding whose name a column of the row has gets
    underscores before it (``_reason``)."""
    mid, diff, reason, at = (fresh(n, left, right) for n in ("matched_id", "diff_columns", "reason", "_at"))
    pairs = res.pairs.select(F.col("row_id").alias(at), F.col("matched_id").alias(mid),
                             F.array_join("diff_columns", ",").alias(diff))
    alone = res.left_only.select(F.col("row_id").alias(at), F.col("reason").alias(reason))
    over = res.right_only.select(F.col("row_id").alias(at))
    return {"matched": left.join(pairs, left[row_id] == F.col(at)).drop(at),
            "left_only": left.join(alone, left[row_id] == F.col(at)).drop(at),
            "right_only": right.join(over, right[right_row_id] == F.col(at), "left_semi")}


def totals(res: ReconcileResult) -> DataFrame:
    return S.run_totals(res.state, res.routed.where(F.col("_side") == RIGHT))


def compare(left: DataFrame, right: DataFrame, key: Sequence[str], base: str | None = None, variant: str = "ascii_lower",
            order_by: Sequence[str] = (), row_id: str = "row_id", **options) -> dict[str, DataFrame]:
    """Pipeline output (``left``) against the baseline: align columns, derive keys, reconcile, sum up, write."""
    diff = schema_diff(left.sparkSession, left, right)
    a, b = kept(*align(nan_to_null(to_date_columns(left)), nan_to_null(to_date_columns(right))))
    cols = [c for c in a.columns if c != row_id]
    name = fresh("pseudo_key", a, b)
    res = reconcile(pseudo_key(a, key, variant, name), pseudo_key(b, key, variant, name), name, cols,
                    order_by=order_by or key[:1], row_id=row_id, rescan=True, **options)
    out = {"columns": diff, **comparison_sheets(res, a, b, row_id, row_id), "totals": totals(res)}
    if base is not None:
        write_results(out, base)
    return out


def flat_vs_extract(flat: DataFrame, extract: DataFrame, key: Sequence[str], base: str | None = None,
                    order_by: Sequence[str] = (), row_id: str = "row_id", consume_exact: bool = True) -> dict[str, DataFrame]:
    """Flat file against a database extract: names lower-cased and sorted, cells as lower-cased text, the flat file's
    stripped."""
    a, b = align(to_date_columns(flat), to_date_columns(extract), drop=("system_datetime",), lower=True, sort=True)
    a, b = kept(nan_to_null(a), nan_to_null(b))
    key = [c.lower() for c in key]
    cols = [c for c in a.columns if c != row_id]
    name = fresh("pseudo_key", a, b)
    res = reconcile(pseudo_key(a, key, "ascii_case", name), pseudo_key(b, key, "ascii_case", name), name, cols,
                    order_by=order_by or key[:1], row_id=row_id, mode="ci", trim_left=True, consume_exact=consume_exact,
                    rescan=True)
    out = {**comparison_sheets(res, a, b, row_id, row_id), "totals": totals(res)}
    if base is not None:
        write_results(out, base)
    return out


def business_checks(data: DataFrame, baseline: DataFrame, by: Sequence[str], key: Sequence[str], base: str | None = None,
                    row_id: str = "row_id", **rules) -> dict[str, DataFrame]:
    """Rows of groups that the baseline holds are compared with it, all other rows go through the business rules."""
    scratch = Scratch(data.sparkSession, "checks")
    data = scratch.written(data, "data")
    # written too: groups are few as a rule, and a table of known size is broadcast, so that no row is shuffled by its group
    held = scratch.written(S.baseline_coverage(data, baseline, by).where("has_baseline").select(
        *[F.col(c).alias(f"_h_{c}") for c in by]), "held")
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    known, new = data.join(held, same, "left_semi"), data.join(held, same, "left_anti")
    rs = build_rules(new, **rules)
    violations = scratch.written(rs.violations(row_id), "violations")
    out = {**{f"compare_{k}": v for k, v in compare(known, baseline, key, None, row_id=row_id).items()},
           "violations": violations, "comments": row_comments(violations, new.columns),
           "rules_not_run": rs.rules_not_run()}
    if base is not None:
        write_results(out, base)
    return out

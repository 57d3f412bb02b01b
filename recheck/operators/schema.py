"""Schema alignment helpers (C1-C6, C8). Plan-time work over column lists; no data pass."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Columns the reference never compares, and the two flag columns its checks append.
ALIGN_DROP = ("System_DateTime", "Key")
DB_ALIGN_DROP = ("system_datetime",)
FLAG_COLUMNS = ("Price_range_flag", "Normalized_name_search_flag")


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns present on one side only: (column, side) with side 'left' or 'right' (C1)."""
    rows = [(c, "left") for c in a.columns if c not in b.columns] + \
           [(c, "right") for c in b.columns if c not in a.columns]
    return spark.createDataFrame(rows, "column string, side string")


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)


def align(a: DataFrame, b: DataFrame, drop: Sequence[str] = ALIGN_DROP, how: str = "common",
          lower: bool = False, sort: bool = False) -> tuple[DataFrame, DataFrame]:
    """Bring two tables to one column list.

    how='common': columns on both sides, in ``a``'s order (a first alignment in the reference);
    how='left':   all of ``a``'s columns, NULL of ``a``'s type where ``b`` lacks one (its repeated alignment).
    ``lower`` lower-cases names first and ``sort`` orders them alphabetically (database variant).
    """
    if lower:
        a = a.toDF(*[c.lower() for c in a.columns])
        b = b.toDF(*[c.lower() for c in b.columns])
    drop = set(drop)
    only_a = [c for c in a.columns if c not in b.columns and c not in drop]
    only_b = [c for c in b.columns if c not in a.columns and c not in drop]
    if only_a or only_b:  # reported before the columns are intersected away
        log.warning("align: columns only on the left %s, only on the right %s", only_a, only_b)
    if how == "common":
        cols = [c for c in a.columns if c in b.columns and c not in drop]
        if sort:
            cols = sorted(cols)
        return a.select(*cols), b.select(*cols)
    if how == "left":
        cols = [c for c in a.columns if c not in drop]
        if sort:
            cols = sorted(cols)
        bt = [F.col(c) if c in b.columns else F.lit(None).cast(a.schema[c].dataType).alias(c) for c in cols]
        return a.select(*cols), b.select(*bt)
    raise ValueError(how)


def canonical_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9]", "", name.lower())


def canonical_headers(df: DataFrame) -> DataFrame:
    """Lower-case names stripped to [a-z0-9] (C4); raises when two columns collapse to one name."""
    names = [canonical_name(c) for c in df.columns]
    dup = {n for n in names if names.count(n) > 1}
    if dup:
        raise ValueError(f"canonical header collision: {sorted(dup)}")
    return df.toDF(*names)


def contract_report(spark: SparkSession, df: DataFrame, contract_columns: Sequence[str],
                    ignore: Sequence[str] = FLAG_COLUMNS) -> DataFrame:
    """'Missing Columns' (in the contract, not in the data) and 'Extra Columns' (the reverse) rows."""
    ignore = set(ignore)
    rows = [("Column Structure", "Missing Columns", c) for c in contract_columns if c not in df.columns]
    rows += [("Column Structure", "Extra Columns", c) for c in df.columns
             if c not in contract_columns and c not in ignore]
    return spark.createDataFrame(rows, "category string, sub_category string, field string")


def mandatory_columns(contract: DataFrame, column: str = "flat_file_column", flag: str = "mandatory_column",
                      yes: str = "Y") -> list[str]:
    """Contract rows flagged mandatory (C6). The contract is a small sheet, so it is read on the driver."""
    return [r[0] for r in contract.where(F.col(flag) == yes).select(column).collect()]

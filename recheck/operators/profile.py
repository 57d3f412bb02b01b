"""Column and file profiles against a data contract.

All counts of a query come from one aggregate pass over the data; results are long tables of findings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recheck.operators.order import with_position
from recheck.operators.schema import FLAG_COLUMNS, contract_report
from recheck.session import materialize

# Contract dtype names (pandas) and the Spark type a value must cast to.
DTYPE_NAMES = {
    "object": "string",
    "int64": "bigint",
    "float64": "double",
    "bool": "boolean",
    "datetime64[ns]": "timestamp",
}
# Category labels of the validation summary.
MANDATORY_CATEGORY = ("Mandatory Fields", "Missing Mandatory Fields")
ALL_NULL_CATEGORY = "All Null Values"
DTYPE_CATEGORY = "Mismatched Data Types"


def _bad(df: DataFrame, c: str, expected: str | None) -> Column:
    """Does a cell, not NULL, fall short of the contract's type? Text must be declared as text, a date must not be a
    number, and a whole number must be whole; else the value must cast."""
    kind = df.schema[c].dataType
    col = F.col(quoted(c))
    if expected is None:
        return F.lit(False)
    if expected == "string":
        bad = F.lit(not isinstance(kind, T.StringType))
    elif expected == "timestamp" and isinstance(kind, T.NumericType):
        bad = F.lit(True)
    elif expected == "bigint" and not isinstance(kind, T.IntegralType):
        number = col.try_cast("double")
        bad = col.try_cast("bigint").isNull() | number.isNull() | (number != F.floor(number))
    else:
        bad = col.try_cast(expected).isNull()
    return col.isNotNull() & bad


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _file_stats(df: DataFrame, cols: Sequence[str], expected: dict, by: str | None) -> DataFrame:
    """One row per file (``by``; none: one row) and column: _file, field, rows, nulls, n_bad. One pass over the data."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(quoted(c)).isNull()).alias(f"_m{i}"),
                 F.count_if(_bad(df, c, expected.get(c))).alias(f"_b{i}")]
    g = df.groupBy(*([F.col(quoted(by)).alias("_file")] if by else [])).agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col("_n").alias("rows"), F.col(f"_m{i}").alias("nulls"),
                                        F.col(f"_b{i}").alias("n_bad")) for i, c in enumerate(cols)]))
    return g.select(*(["_file"] if by else [F.lit(None).cast("string").alias("_file")]), each.alias("s")).select("_file", "s.*")


def _missing(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    pct = F.col("nulls").cast("double") / F.col("rows").cast("double") * 100
    return stats.where(F.col("_file").isNotNull() & (F.col("nulls") > 0) & F.col("field").isin(*cols)).select(
        F.lit(MANDATORY_CATEGORY[0]).alias("category"), F.lit(MANDATORY_CATEGORY[1]).alias("sub_category"),
        "field", F.col("_file").alias("file_name"), pct.alias("missing_pct"))


def _flagged(stats: DataFrame) -> DataFrame:
    total = stats.groupBy("field").agg(*[F.sum(c).alias(c) for c in ("rows", "nulls", "n_bad")])
    empty = F.col("nulls") == F.col("rows")
    return total.where(empty | (F.col("n_bad") > 0)).select(
        F.when(empty, ALL_NULL_CATEGORY).otherwise(DTYPE_CATEGORY).alias("category"), "field",
        F.when(~empty, F.col("n_bad")).alias("n_bad"))


def _expected(df: DataFrame, contract: dict[str, str]) -> dict[str, str]:
    return {c: DTYPE_NAMES.get(t, t) for c, t in contract.items() if c in df.columns}


def missing_pct(df: DataFrame, cols: Sequence[str], by: str = "file_name") -> DataFrame:
    """NULL % per file x column, only where > 0 (A1). One grouped pass; NULL files drop out (0/0 is not > 0)."""
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "category string, sub_category string, field string, file_name string, missing_pct double")
    return _missing(_file_stats(df, cols, {}, by), cols)


def all_null_columns(df: DataFrame) -> DataFrame:
    """Columns holding no value at all (A2)."""
    return _flagged(_file_stats(df, df.columns, {}, None)).select("category", "field")


def dtype_conformance(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Contract columns present in the data, not all NULL, with values that are not of the contract type (A3).

    ``contract`` maps column -> pandas dtype name; ``n_bad`` counts the values that fall short of it (``_bad``).
    """
    expected = _expected(df, contract)
    return _flagged(_file_stats(df, df.columns, expected, None)).where(F.col("category") == DTYPE_CATEGORY).select(
        "category", "field", "n_bad")


def flagged_columns(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """All-NULL columns and dtype mismatches from one pass, with their places in the sheet: category descending, then
    column (A2 + A3, O3)."""
    found = _flagged(_file_stats(df, df.columns, _expected(df, contract), None))
    return with_position(found, ["-category", "field"], row_id="field")


def write_profiled(df: DataFrame, contract: dict[str, str], path: str) -> DataFrame:
    """Writes ``df`` to ``path`` and returns its flagged columns (category, field, n_bad), counted on the way: no pass of
    their own for A2 and A3."""
    seen, expected = Observation(), _expected(df, contract)
    counts = [x for i, c in enumerate(df.columns) for x in (
        F.count(F.col(quoted(c))).alias(f"v{i}"), F.count_if(_bad(df, c, expected.get(c))).alias(f"b{i}"))]
    df.observe(seen, *counts).write.parquet(path)
    got = seen.get
    rows = [(ALL_NULL_CATEGORY if not got[f"v{i}"] else DTYPE_CATEGORY, c, got[f"b{i}"] if got[f"v{i}"] else None)
            for i, c in enumerate(df.columns) if not got[f"v{i}"] or got[f"b{i}"]]
    return df.sparkSession.createDataFrame(rows, "category string, field string, n_bad bigint")


def validation_summary(spark: SparkSession, df: DataFrame, contract_rows: Sequence[tuple],
                       ignore: Sequence[str] = FLAG_COLUMNS, by: str = "file_name") -> DataFrame:
    """Column structure + missing % of mandatory columns + flagged columns, one long table.

    ``contract_rows``: (column, dtype, mandatory flag, possible values) tuples of the mapping sheet.
    """
    cols = [r[0] for r in contract_rows]
    mandatory = [r[0] for r in contract_rows if r[2] == "Y"]
    structure = contract_report(spark, df, cols, ignore)
    # counts by file and column, read by both findings: written once
    stats = materialize(_file_stats(df, df.columns, _expected(df, {r[0]: r[1] for r in contract_rows}), by))
    miss, flagged = _missing(stats, mandatory), _flagged(stats)
    return (structure.unionByName(miss, allowMissingColumns=True)
            .unionByName(flagged, allowMissingColumns=True)
            .select("category", "sub_category", "field", "file_name", "missing_pct", "n_bad"))


def contract_rows(contract: DataFrame) -> list[tuple]:
    """The mapping sheet as driver-side tuples (a contract is tens of rows)."""
    return [tuple(r) for r in contract.select("flat_file_column", "dtype", "mandatory_column",
                                              "possible_values").collect()]

"""Price statistics per normalised item.

Statistics are grouped aggregates (partial aggregation before the shuffle), joined back to rows where needed; the
join side holding one row per item is broadcast by AQE only when its measured size allows. The exact percentile of an
item of more than ``HOT_POINTS`` rows is found by ranks over range partitions (``order.percentiles``): no task holds that
item's prices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.operators.order import percentiles, sort_columns

# Rows of an item from which on its percentile is found by ranks; below it, one task holds the item's distinct prices.
HOT_POINTS = 1_000_000


def drop_zero(df: DataFrame, col: str = "unit_price") -> DataFrame:
    """Drop rows whose price is exactly 0; NULL prices stay (F1)."""
    return df.where((F.col(col) != 0) | F.col(col).isNull())


def _grouped(df: DataFrame, name: str, price: str, aggs: list[Column], exact: bool, hot_points: int | None) -> DataFrame:
    """``aggs`` and ``percentile_25th`` by item (a NULL item has none). One aggregate, besides the items of more than
    ``hot_points`` rows; whether there are any is asked first, in one pass over the item column."""
    item, cost = F.col(name), F.col(price)
    hot = None
    if exact and hot_points is not None:
        counts = df.where(item.isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_points)
        hot = counts.select(F.col(name).alias("_hot"))
        if not hot.take(1):
            hot = None
    if hot is not None:
        df = df.join(hot, item == F.col("_hot"), "left")
        ranked = percentiles(df.where(F.col("_hot").isNotNull()), name, price, 0.25).select(
            F.col(name).alias("_hot"), F.col("percentile").alias("_p"))
        cost = F.when(F.col("_hot").isNull(), cost)
    q = F.percentile(cost, 0.25) if exact else F.percentile_approx(price, 0.25, 100000).cast("double")
    # numpy's percentile of a group holding a NaN is NaN; Spark's ignores NULLs, so guard it.
    no_null = F.count_if(F.col(price).isNull()) == 0
    g = df.groupBy(name).agg(*aggs, F.when(no_null, q).alias("percentile_25th"), no_null.alias("_whole"))
    if hot is not None:
        g = g.join(ranked, item == F.col("_hot"), "left").withColumn("percentile_25th", F.coalesce(
            "percentile_25th", F.when(F.col("_whole"), F.col("_p"))))
    return g.drop("_whole", "_hot", "_p")


def _stats(price: str, count_offset: int) -> list[Column]:
    return [(F.count(F.lit(1)) - count_offset).alias("no_of_price_points"), F.min(price).alias("low_price"),
            F.avg(price).alias("avg_price")]


def price_stats_per_row(df: DataFrame, name: str = "sku_normalized", price: str = "unit_price",
                        exact_percentile: bool = True, hot_points: int | None = HOT_POINTS) -> DataFrame:
    """Each row with its item's stats: points other than this one (n-1), min, p25 (linear), mean (A5).

    Rows with a NULL item get NULL stats (pandas drops NULL group keys before the merge back).
    ``exact_percentile=False`` uses ``percentile_approx``.
    """
    g = _grouped(df.where(F.col(name).isNotNull()), name, price, _stats(price, 1), exact_percentile, hot_points)
    return df.join(g, name, "left")


def price_stats_by_name(df: DataFrame, name: str = "sku_normalized", price: str = "unit_price",
                        first_cols: Sequence[str] = ("level5_category", "uom"), order: str = "row_id",
                        sort: Sequence[str] = (),
                        exact_percentile: bool = True, hot_points: int | None = HOT_POINTS) -> DataFrame:
    """One row per item: n, min, p25, mean, with the first row's category and unit.

    The NULL item keeps its row (first row's category and unit) with NULL statistics, as the reference's
    merge-then-drop_duplicates does. ``sort`` orders the result; rows with their positions: ``order.with_position``.
    """
    first = F.min_by(F.struct(*first_cols), F.col(order))
    g = _grouped(df, name, price, [first.alias("_f"), *_stats(price, 0)], exact_percentile, hot_points)
    stat_cols = ["no_of_price_points", "low_price", "percentile_25th", "avg_price"]
    out = g.select(*[F.col(f"_f.{c}").alias(c) for c in first_cols], name,
                   *[F.when(F.col(name).isNotNull(), F.col(c)).alias(c) for c in stat_cols])
    return out.orderBy(*sort_columns(sort)) if sort else out


def drop_duplicates_first(df: DataFrame, subset: Sequence[str], order: str = "row_id") -> DataFrame:
    """``drop_duplicates(subset)`` keeping the first row in ``order`` (W1); the NULL key is one group.

    A grouped ``min_by`` over the whole row: partial aggregation keeps a hot key from loading one task.
    """
    rest = [c for c in df.columns if c not in subset]
    g = df.groupBy(*subset).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r"))
    return g.select(*subset, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)

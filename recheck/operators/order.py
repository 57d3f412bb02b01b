"""Global order without a global window: gapless positions, running sums and exact ranks over range partitions (O1-O3).

Rows are range-partitioned and sorted, each gets its place in its partition, and only one number a partition (and group)
is summed up over the partitions. No task holds more than its range: a hot group is split by what it is sorted by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recheck.session import Scratch

_PLACE_BITS = 33  # of monotonically_increasing_id: partition number above, place in the partition below


def sort_columns(sort: Sequence[str]) -> list[Column]:
    """'name' or '-name' (descending); NULLs last either way, as in the reference's sorted sheets."""
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in sort]


def in_order(df: DataFrame, sort: Sequence[Column], scratch: Scratch, name: str, place: str = "_place") -> DataFrame:
    """``df`` written in global order with ``place``, a number that ascends with it."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return scratch.written(df.repartitionByRange(n, *sort).sortWithinPartitions(*sort).withColumn(
        place, F.monotonically_increasing_id()), name)


def with_position(df: DataFrame, sort: Sequence[str], name: str = "position", row_id: str = "row_id") -> DataFrame:
    """``df`` with its rows' numbers from 1 in the order of ``sort`` (``row_id`` breaks ties): the rows of a sorted sheet.

    One number a partition goes to the driver, and comes back inside the plan: no join, no window.
    """
    scratch = Scratch(df.sparkSession, "order")
    ties = [F.col(row_id).asc_nulls_last()] if row_id not in {c.lstrip("-") for c in sort} else []
    rows = in_order(df, [*sort_columns(sort), *ties], scratch, "rows")
    part = F.shiftright("_place", _PLACE_BITS).cast("int")
    counts = {r["p"]: r["n"] for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []
    for p in range(max(counts, default=-1) + 1):
        starts.append(before)
        before += counts.get(p, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts or [0]]), part + 1)
    return rows.withColumn(name, start + F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1).drop("_place")


def with_rank(df: DataFrame, group: Sequence[str], sort: Sequence[Column], scratch: Scratch, name: str = "rank",
              total: str = "total", table: str = "ranked") -> DataFrame:
    """``df`` with each row's number from 0 within its group, in the order of ``sort`` (which must be total for numbers
    that reruns agree on), and the rows of the group. NULL is a group value like any other.

    Rows are in global order of (group, sort): a group's rows in one partition stand together, so a row's number is its
    place there less that of the group's first, plus the group's rows in the partitions before.
    """
    from pyspark.sql import Window
    keys = [F.col(g) for g in group]
    rows = in_order(df, [*[k.asc_nulls_last() for k in keys], *sort], scratch, table)
    rows = rows.withColumn("_p", F.shiftright("_place", _PLACE_BITS).cast("int"))
    parts = rows.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    up = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*[k.alias(f"_g{i}") for i, k in enumerate(keys)], F.col("_p").alias("_p2"), "_first",
                          F.coalesce(F.sum("_n").over(up), F.lit(0)).alias("_start"),
                          F.sum("_n").over(Window.partitionBy(*group)).alias(total))
    same = F.col("_p") == F.col("_p2")
    for i, k in enumerate(keys):
        same = same & k.eqNullSafe(F.col(f"_g{i}"))
    return rows.join(starts, same).withColumn(name, F.col("_start") + F.col("_place") - F.col("_first")).drop(
        "_place", "_p", "_p2", "_first", "_start", *[f"_g{i}" for i in range(len(keys))])


def percentiles(df: DataFrame, group: str, value: str, q: float) -> DataFrame:
    """(group, percentile) with linear interpolation between the two nearest ranks; exact for groups of any size.

    Values are counted by (group, value), the counts put in order, and summed up: over the partitions a number for each
    partition and group, inside a partition by a window over the rows of one group there. The values at the two ranks
    are those whose running counts enclose them. NULL groups and NULL values are left out.
    """
    from pyspark.sql import Window
    scratch = Scratch(df.sparkSession, "percentiles")
    counted = (df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
               .where(F.col("g").isNotNull() & F.col("v").isNotNull()).groupBy("g", "v").agg(F.count(F.lit(1)).alias("c")))
    rows = in_order(counted, [F.col("g").asc(), F.col("v").asc()], scratch, "values")
    rows = rows.withColumn("p", F.shiftright("_place", _PLACE_BITS).cast("int"))
    parts = rows.groupBy("g", "p").agg(F.sum("c").alias("n"))  # a row for each partition that a group reaches
    up = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g")
    starts = parts.select(F.col("g").alias("g2"), F.col("p").alias("p2"), F.coalesce(F.sum("n").over(up), F.lit(0)).alias(
        "start"), F.sum("n").over(whole).alias("total"))
    inside = Window.partitionBy("g", "p").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("to", F.sum("c").over(inside)).join(
        starts, (F.col("g") == F.col("g2")) & (F.col("p") == F.col("p2")))
    rank = F.lit(q) * (F.col("total") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    to, of = F.col("start") + F.col("to"), F.col("start") + F.col("to") - F.col("c")
    at = run.select("g", rank.alias("rank"), low.alias("low"), high.alias("high"),
                    F.when((of <= low) & (low < to), F.col("v")).alias("a"),
                    F.when((of <= high) & (high < to), F.col("v")).alias("b")).where("a IS NOT NULL OR b IS NOT NULL")
    a, b = F.max("a"), F.max("b")
    share = F.max(F.col("rank") - F.col("low"))
    return at.groupBy(F.col("g").alias(group)).agg(
        F.when(a == b, a).otherwise(a * (1 - share) + b * share).alias("percentile"))

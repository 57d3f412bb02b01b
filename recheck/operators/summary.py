"""File- and field-level summaries of a reconciliation.

Every summary is one grouped aggregate; per-column counts are computed side by side in a single ``agg`` and then
``unpivot``-ed to a long (file_name, field, n) table, so the number of passes does not grow with the column count.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recheck.functions.cells import comparable, strip
from recheck.operators.order import with_rank
from recheck.session import Scratch

# File-level issue types (all other issue types are fields).
FILE_LEVEL_ISSUES = ("missing_rows", "extra_rows", "duplicate_rows")


# Rows of either side whose pairs one task of the literal merge makes at a time.
MERGE_BLOCK = 512


def outer_by_key(gt: DataFrame, pl: DataFrame, key: str, suffixes=("_gt", "_pl"), block: int = MERGE_BLOCK) -> DataFrame:
    """Many-to-many full outer join on ``key`` with every column suffixed per side (J4). A key with n and m rows yields
    n*m rows; the summaries below never build it.

    Spark cannot split a key of a full outer join, so pairs are addressed: rows are numbered inside their key (over range
    partitions, no task holds a key), numbers fall into blocks of ``block``, and a pair of blocks is one value of an
    equi-join's key: a row goes to each block of the other side. Rows of keys that the other side lacks are added.
    """
    scratch = Scratch(gt.sparkSession, "outer")
    counts = (gt.select(F.col(key).alias("_ck"), F.lit(0).alias("_s")).unionByName(
        pl.select(F.col(key).alias("_ck"), F.lit(1).alias("_s"))).where(F.col("_ck").isNotNull()).groupBy("_ck").agg(
        F.count_if(F.col("_s") == 0).alias("_n"), F.count_if(F.col("_s") == 1).alias("_m")))

    def side(df: DataFrame, suffix: str, other: str, mine: str, theirs: str, name: str) -> tuple[DataFrame, DataFrame]:
        own = df.select(F.struct(*[F.col(c).alias(c + suffix) for c in df.columns]).alias(f"_{name}"), F.col(key).alias("_k"))
        # any order serves: numbers are written with the rows, and a pair of blocks is made whole in any case
        ranked = with_rank(own, ["_k"], [F.xxhash64(f"_{name}").asc()], scratch, table=name).join(
            counts, F.col("_k") == F.col("_ck"), "left")
        blocks = F.ceil(F.col(other) / block).cast("int")
        met = ranked.where(F.col(other) > 0).select(
            "_k", f"_{name}", F.floor(F.col("rank") / block).cast("int").alias(mine),
            F.explode(F.sequence(F.lit(0), blocks - 1)).alias(theirs))
        return met, ranked.where(F.coalesce(F.col(other), F.lit(0)) == 0).select(f"_{name}")

    a, only_a = side(gt, suffixes[0], "_m", "_i", "_j", "a")
    b, only_b = side(pl, suffixes[1], "_n", "_j", "_i", "b")
    pairs = a.join(b, ["_k", "_i", "_j"]).select("_a.*", "_b.*")
    return pairs.unionByName(only_a.select("_a.*"), allowMissingColumns=True).unionByName(
        only_b.select("_b.*"), allowMissingColumns=True)


def rows_per_file(df: DataFrame, by: str = "file_name") -> DataFrame:
    """Distinct files and rows per file (A9, F2). NULL file names are dropped as pandas' groupby does."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("total_rows"))


def filter_by(df: DataFrame, col: str, value) -> DataFrame:
    """Rows whose ``col`` equals ``value`` (F2); per-value row counts come from ``rows_per_file`` in one pass."""
    return df.where(F.col(col) == F.lit(value))


def _key_marker(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("_mk")).distinct().withColumn("_hit", F.lit(True))


def missing_per_file(gt: DataFrame, pl: DataFrame, key: str, by: str = "file_name") -> DataFrame:
    """Baseline rows per file whose key the candidate never produced (A10); every baseline file is listed."""
    j = gt.join(_key_marker(pl, key), F.col(key) == F.col("_mk"), "left")
    return (j.where(F.col(by).isNotNull()).groupBy(by)
            .agg(F.count_if(F.col("_hit").isNull()).alias("missing_rows")))


def extra_per_file(gt: DataFrame, pl: DataFrame, key: str, by: str = "file_name") -> DataFrame:
    """Candidate rows per (candidate) file whose key has no baseline row."""
    j = pl.join(_key_marker(gt, key), F.col(key) == F.col("_mk"), "left")
    return (j.where(F.col(by).isNotNull()).groupBy(by)
            .agg(F.count_if(F.col("_hit").isNull()).alias("extra_rows")))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None, by: str | None = None,
                   threshold: int = 0) -> DataFrame:
    """Rows that have at least one exact copy over ``cols`` (NULLs equal), in total or per ``by``.

    Counted with a grouped aggregate (partial aggregation absorbs hot groups); a total below ``threshold`` is reported
    as 0 (the counts per file never are).
    """
    cols = list(cols or df.columns)
    keys = cols if by is None or by in cols else [by] + cols
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    if by is None:
        out = g.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("duplicate_rows"))
    else:
        return g.groupBy(by).agg(F.sum("_n").cast("bigint").alias("duplicate_rows"))
    return _from_threshold(out, threshold)


def _from_threshold(total: DataFrame, threshold: int) -> DataFrame:
    n = F.col("duplicate_rows")
    return total.withColumn("duplicate_rows", F.when(n >= threshold, n).otherwise(0)) if threshold else total


def mark_duplicates(df: DataFrame, cols: Sequence[str], name: str = "has_copy") -> DataFrame:
    """Per-row flag: another row has the same ``cols`` (``duplicated(keep=False)``, NULLs equal).

    A grouped count joined back (NULL-safe) rather than a window, so a hot group is partially aggregated and its
    join side split by AQE instead of being sorted whole in one task.
    """
    k = [f"_d{i}" for i in range(len(cols))]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).toDF(*k, "_n")
    cond = None
    for c, kk in zip(cols, k):
        e = df[c].eqNullSafe(g[kk])
        cond = e if cond is None else cond & e
    out = df.join(g, cond, "left")
    return out.select(*df.columns, F.col("_n").isNotNull().alias(name))


def _long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str) -> DataFrame:
    return df.unpivot(list(ids), list(cols), "field", name)


def mismatch_counts(merged: DataFrame, cols: Sequence[str], by: str = "file_name_gt",
                    suffixes=("_gt", "_pl")) -> DataFrame:
    """Per file x column: merged rows whose two sides differ, NULL-safe (A13). Labelled by the compared column."""
    aggs = [F.count_if(~F.col(c + suffixes[0]).eqNullSafe(F.col(c + suffixes[1]))).alias(c) for c in cols]
    g = merged.where(F.col(by).isNotNull()).groupBy(F.col(by).alias("file_name")).agg(*aggs)
    return _long(g, ["file_name"], cols, "mismatches")


def _long_values(df: DataFrame, other: DataFrame, ids: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(ids..., field, v): every value as a text that equals the other side's exactly where the cells are equal."""
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), comparable(
        c, df.schema[c].dataType, other.schema[c].dataType).alias("v")) for c in cols]))
    return df.select(*ids, st.alias("_s")).select(*ids, "_s.field", "_s.v")


def key_mismatch_counts(gt: DataFrame, pl: DataFrame, key: str, cols: Sequence[str],
                        by: str = "file_name") -> DataFrame:
    """A13 without building the key outer merge: per baseline file x column, merged rows whose sides differ.

    For a baseline value ``v`` of a key with ``n`` candidate rows, ``n - n(v)`` of its merged rows differ
    (NULL-safe); with no candidate row the merged row differs iff ``v`` is not NULL. Both sides are aggregated to
    one row per (key, column, value) before the single join, so a hot key or value never loads one task.
    """
    g = (_long_values(gt.where(F.col(by).isNotNull()), pl, [key, by], cols)
         .groupBy(key, by, "field", "v").agg(F.count(F.lit(1)).alias("_cg")))
    p = _long_values(pl, gt, [key], cols).groupBy(key, "field", "v").agg(F.count(F.lit(1)).alias("_cp"))
    n = pl.groupBy(key).agg(F.count(F.lit(1)).alias("_np"))
    j = (g.join(n, key, "left")
         .join(p.withColumnRenamed(key, "_pk").withColumnRenamed("field", "_pf").withColumnRenamed("v", "_pv"),
               (F.col(key) == F.col("_pk")) & (F.col("field") == F.col("_pf")) & F.col("v").eqNullSafe(F.col("_pv")),
               "left"))
    np_, cp = F.coalesce(F.col("_np"), F.lit(0)), F.coalesce(F.col("_cp"), F.lit(0))
    contrib = F.when(np_ > 0, F.col("_cg") * (np_ - cp)).otherwise(F.when(F.col("v").isNotNull(), F.col("_cg")).otherwise(0))
    return j.groupBy(F.col(by).alias("file_name"), "field").agg(F.sum(contrib).cast("bigint").alias("mismatches"))


def merge_duplicate_rows(gt: DataFrame, pl: DataFrame, key: str, gt_cols: Sequence[str], pl_cols: Sequence[str],
                         by: str | None = None, threshold: int = 0) -> DataFrame:
    """A12 without building the key outer merge: merged rows having an exact copy, in total or per baseline file.

    A merged class (baseline class, candidate class) of one key occurs ``c_g * c_p`` times, so a key with both
    sides contributes ``n_g * n_p - s_g * s_p`` copied rows (``s``: classes seen once); a one-sided key contributes
    its classes seen more than once.
    """
    gcols = [c for c in gt_cols if c != key]
    pcols = [c for c in pl_cols if c != key]
    gk_by = [key] + ([by] if by else [])
    gc = gt.groupBy(key, *gcols).agg(F.count(F.lit(1)).alias("_c"))
    if by and by not in gcols:
        raise ValueError("the per-file column must be one of the baseline columns")
    gs = gc.groupBy(*gk_by).agg(F.sum("_c").alias("_ng"), F.count_if(F.col("_c") == 1).alias("_sg"),
                               F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("_dg"))
    pc = pl.groupBy(key, *pcols).agg(F.count(F.lit(1)).alias("_c"))
    ps = pc.groupBy(F.col(key).alias("_pk")).agg(
        F.sum("_c").alias("_np"), F.count_if(F.col("_c") == 1).alias("_sp"),
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("_dp"))
    j = gs.join(ps, F.col(key) == F.col("_pk"), "full_outer")
    both = F.col("_ng").isNotNull() & F.col("_np").isNotNull()
    dup = (F.when(both, F.col("_ng") * F.col("_np") - F.col("_sg") * F.col("_sp"))
           .when(F.col("_ng").isNotNull(), F.col("_dg")).otherwise(F.col("_dp")))
    if by:
        return j.groupBy(by).agg(F.sum(dup).cast("bigint").alias("duplicate_rows"))
    return _from_threshold(j.agg(F.coalesce(F.sum(dup), F.lit(0)).cast("bigint").alias("duplicate_rows")), threshold)


def merge_profile(gt: DataFrame, pl: DataFrame, key: str) -> DataFrame:
    """Per key of the outer merge: baseline rows, candidate rows and merged rows (``n*m`` or ``n + m``) (J4 shape)."""
    g = gt.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("gt_rows"))
    p = pl.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("pl_rows"))
    j = g.join(p, "key", "full_outer").fillna(0, ["gt_rows", "pl_rows"])
    m = F.when((F.col("gt_rows") > 0) & (F.col("pl_rows") > 0), F.col("gt_rows") * F.col("pl_rows"))         .otherwise(F.col("gt_rows") + F.col("pl_rows"))
    return j.withColumn("merged_rows", m)


def pair_diff_counts(pairs_with_file: DataFrame, cols: Sequence[str], by: str = "file_name") -> DataFrame:
    """Wide per-file table: matched rows and, per compared column, pairs where it differs (A14 wide, A18)."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(F.array_contains("diff_columns", c)).alias(c + DIFF_SUFFIX) for c in cols]
    return pairs_with_file.groupBy(by).agg(*aggs)


DIFF_SUFFIX = "_diffs"


def _long_diffs(w: DataFrame, ids, cols) -> DataFrame:
    long = w.unpivot(list(ids), [c + DIFF_SUFFIX for c in cols], "field", "diffs")
    return long.withColumn("field", F.expr(f"left(field, length(field) - {len(DIFF_SUFFIX)})"))


def diff_counts_by_file(pairs_with_file: DataFrame, cols: Sequence[str], by: str = "file_name") -> DataFrame:
    """Long (file_name, field, diffs), zeros included."""
    w = pair_diff_counts(pairs_with_file, cols, by).drop("total_rows")
    return _long_diffs(w, [by], cols)


def diff_totals(diff_counts: DataFrame) -> DataFrame:
    """Per column, diffs summed over files."""
    return diff_counts.groupBy("field").agg(F.sum("diffs").cast("bigint").alias("diffs"))


def category_accuracy(pairs_with_file: DataFrame, cols: Sequence[str], by: str = "file_name") -> DataFrame:
    """Per column: accuracy over matched rows, round((total - diffs) / total * 100, 2), and files with diffs."""
    w = pair_diff_counts(pairs_with_file, cols, by)
    long = _long_diffs(w, [by, "total_rows"], cols)
    g = long.groupBy("field").agg(F.sum("diffs").alias("_d"), F.sum("total_rows").alias("_t"),
                                  F.count_if(F.col("diffs") != 0).alias("files_affected"))
    acc = F.round((F.col("_t") - F.col("_d")).cast("double") / F.col("_t").cast("double") * 100, 2)
    return g.select("field", acc.alias("accuracy"), "files_affected")


def outer_completeness(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: 100 - round(null % over the all-column NULL-safe outer merge of ``a`` and ``b``, 2).

    The merge is never built: both sides are tagged and grouped on all columns; a group with ``x`` rows on the left
    and ``y`` on the right stands for ``x*y`` merged rows if both are positive, else ``x + y``.
    """
    cols = list(cols)
    u = (a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b"))
         .unionByName(b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))))
    g = u.groupBy(*cols).agg(F.sum("_a").alias("_x"), F.sum("_b").alias("_y"))
    wt = F.when((F.col("_x") > 0) & (F.col("_y") > 0), F.col("_x") * F.col("_y")).otherwise(F.col("_x") + F.col("_y"))
    g = g.withColumn("_w", wt)
    tot = g.agg(F.sum("_w").alias("_t"), *[F.sum(F.when(F.col(c).isNull(), F.col("_w")).otherwise(0)).alias(c)
                                           for c in cols])
    long = tot.unpivot(["_t"], cols, "field", "_nulls")
    pct = F.lit(100) - F.round(F.col("_nulls").cast("double") / F.col("_t").cast("double") * 100, 2)
    return long.select("field", pct.alias("match_pct"))


def file_level_accuracy(gt: DataFrame, pl: DataFrame, key: str, cols: Sequence[str], by: str = "file_name",
                        dup_cols: tuple[Sequence[str], Sequence[str]] | None = None,
                        dup_by_file: DataFrame | None = None) -> DataFrame:
    """Wide per-file table of the key outer merge -- total, missing, extra, duplicate rows, mismatches per column --
    computed from per-key aggregates; the merge itself is never built. ``dup_cols``: (baseline, candidate) columns
    that define a duplicate merged row (default: all columns of each side)."""
    total = rows_per_file(gt, by)
    miss = missing_per_file(gt, pl, key, by)
    extra = extra_per_file(gt, pl, key, by)
    gcols, pcols = dup_cols if dup_cols is not None else (gt.columns, pl.columns)
    dup = dup_by_file if dup_by_file is not None else merge_duplicate_rows(gt, pl, key, gcols, pcols, by=by)
    mm = key_mismatch_counts(gt, pl, key, cols, by)
    wide = mm.groupBy("file_name").pivot("field", list(cols)).agg(F.first("mismatches"))
    out = (total.join(miss, by, "left").join(extra, by, "left").join(dup, by, "left").join(wide, by, "left")
           .fillna(0, ["missing_rows", "extra_rows", "duplicate_rows"]))
    return out.select(by, "total_rows", "missing_rows", "extra_rows", "duplicate_rows", *cols)


def issue_summary(file_table: DataFrame, cols: Sequence[str], completeness: DataFrame | None = None,
                  duplicates_total: DataFrame | None = None, parity: bool = False) -> DataFrame:
    """Per issue type: accuracy round(100 - errors / rows * 100, 2), level, files affected, % missing, % incorrect
    (A17). % missing: files that the table has no count for. ``parity=True`` counts affected files as the reference (errors > 0 and file accuracy != 0)."""
    measures = list(FILE_LEVEL_ISSUES) + list(cols)
    long = file_table.select("file_name", "total_rows", *[F.col(m).cast("bigint").alias(m) for m in measures]) \
        .unpivot(["file_name", "total_rows"], measures, "issue_type", "errors")
    hit = F.col("errors") > 0
    if parity:
        hit = hit & ((F.lit(100.0) - F.col("errors") / F.col("total_rows") * 100) != 0)
    g = long.groupBy("issue_type").agg(F.sum("errors").alias("_e"), F.sum("total_rows").alias("_t"),
                                       F.count_if(hit).alias("files_affected"),
                                       (F.avg(F.col("errors").isNull().cast("int")) * 100).alias("pct_missing"))
    out = g.select(
        "issue_type",
        F.when(F.col("issue_type").isin(*FILE_LEVEL_ISSUES), F.lit("File")).otherwise(F.lit("Field")).alias("issue_level"),
        F.round(F.lit(100.0) - F.col("_e").cast("double") / F.col("_t").cast("double") * 100, 2).alias("accuracy"),
        "files_affected", "pct_missing")
    inc = None
    if completeness is not None:
        inc = completeness.select(F.col("field").alias("issue_type"), F.col("match_pct").alias("pct_incorrect"))
    if duplicates_total is not None:
        d = duplicates_total.select(F.lit("duplicate_rows").alias("issue_type"),
                                    F.col("duplicate_rows").cast("double").alias("pct_incorrect"))
        inc = d if inc is None else inc.unionByName(d)
    if inc is None:
        return out.withColumn("pct_incorrect", F.lit(None).cast("double"))
    return out.join(inc, "issue_type", "left")


def file_measures(gt: DataFrame, pl: DataFrame, key: str, cols: Sequence[str], by: str = "file_name",
                  dup_cols: tuple[Sequence[str], Sequence[str]] | None = None, complete: tuple | None = None) -> DataFrame:
    """All measures of the key outer merge in one table of sums: a row for each file of either side (``_file``), and, with
    ``complete`` = (a, b, columns), one for the all-column merge of A19 (``_tag`` 1).

    The merge is never built. Equal rows of a side are one class (one shuffle, read by both parts below).
    * Per (key, side, file): rows, classes seen once, rows of classes seen more often, cells that are not NULL. A window
      over a key's files adds the other side's numbers. From these: rows, missing, extra, copied rows, and for every
      column all pairs of the key, or its cells that are not NULL where the candidate has no row of the key.
    * From the pairs go those that agree: per (key, column, value) baseline rows times candidate rows.
    Everything is then one grouped sum of wide rows.
    """
    gcols, pcols = (list(x) for x in (dup_cols if dup_cols is not None else (gt.columns, pl.columns)))
    if not set(cols) | {by} <= set(gcols) or not set(cols) <= set(pcols):
        raise ValueError("the compared columns and the file column must be among those that define a copied row")
    n = len(cols)

    def texts(df: DataFrame, other: DataFrame, names: Sequence[str]):
        out = [comparable(c, df.schema[c].dataType, (other if c in other.columns else df).schema[c].dataType) for c in names]
        return F.array(*out) if out else F.array().cast("array<string>")

    def side(df: DataFrame, other: DataFrame, own: list[str], which: int) -> DataFrame:
        rest = [c for c in own if c not in cols and c not in (key, by)]
        file = F.col(by).cast("string") if by in df.columns else F.lit(None).cast("string")
        return df.select(F.col(key).cast("string").alias("k"), F.lit(which).alias("side"), file.alias("file"),
                         texts(df, other, cols).alias("v"), texts(df, other, rest).alias("rest"))

    c = F.col("c")
    classes = side(gt, pl, gcols, 0).unionByName(side(pl, gt, pcols, 1)).groupBy("k", "side", "file", "v", "rest").agg(
        F.count(F.lit(1)).alias("c"))
    per = classes.groupBy("k", "side", "file").agg(
        F.sum("c").alias("n"), F.count_if(c == 1).alias("s"), F.sum(F.when(c > 1, c).otherwise(0)).alias("d"),
        *[F.sum(F.when(F.get("v", F.lit(i)).isNotNull(), c).otherwise(0)).alias(f"nn{i}") for i in range(n)])
    of_key = Window.partitionBy("k", F.when(F.col("k").isNull(), F.col("side")))  # NULL keys meet nothing

    def across(which: int, x: str):
        return F.coalesce(F.sum(F.when(F.col("side") == which, F.col(x))).over(of_key), F.lit(0))

    per = per.withColumns({"np": across(1, "n"), "sp": across(1, "s"), "ng": across(0, "n")})
    base, cand, rows, none = F.col("side") == 0, F.col("side") == 1, F.col("n"), F.lit(None).cast("bigint")
    met = F.col("np") > 0
    sums = ["total_rows", "missing_rows", "extra_rows", "duplicate_rows"] + [f"m{i}" for i in range(n)]
    extra = ["w", *[f"z{i}" for i in range(n)]] if complete is not None else []
    keyed = per.select(
        F.lit(0).alias("_tag"),
        # copied rows of keys that only the candidate has belong to no baseline file: they stand in a row of their own
        F.explode(F.when(cand & (F.col("ng") == 0) & (F.col("d") > 0), F.array(
            F.struct(F.col("file").alias("f"), F.lit(False).alias("o")), F.struct(
                F.lit(None).cast("string").alias("f"), F.lit(True).alias("o")))).otherwise(F.array(F.struct(
                    F.col("file").alias("f"), F.lit(False).alias("o"))))).alias("x"), "*").select(
        "_tag", F.col("x.f").alias("_file"), F.when(base, rows).alias("total_rows"),
        F.when(base, F.when(met, 0).otherwise(rows)).alias("missing_rows"),
        F.when(cand & ~F.col("x.o"), F.when(F.col("ng") == 0, rows).otherwise(0)).alias("extra_rows"),
        F.when(base, F.when(met, rows * F.col("np") - F.col("s") * F.col("sp")).otherwise(F.col("d")))
        .when(F.col("x.o"), F.col("d")).alias("duplicate_rows"),
        *[F.when(base, F.when(met, rows * F.col("np")).otherwise(F.col(f"nn{i}"))).alias(f"m{i}") for i in range(n)],
        *[none.alias(x) for x in extra])
    # no filter here that Spark could push below the classes: they are to be the same in both parts, to be made once
    cells = (classes.select("k", "side", F.when(base, F.col("file")).alias("file"), F.when(
        F.col("k").isNotNull(), c).alias("c"), F.posexplode_outer("v").alias("i", "x"))
             .groupBy("k", "i", "x", "side", "file").agg(F.sum("c").alias("c")))
    agree = cells.withColumn("cp", F.sum(F.when(cand, c)).over(Window.partitionBy("k", "i", "x"))).where(
        base & F.col("cp").isNotNull()).select(
        F.lit(0).alias("_tag"), F.col("file").alias("_file"), *[none.alias(x) for x in sums[:4]],
        *[F.when(F.col("i") == i, -c * F.col("cp")).alias(f"m{i}") for i in range(n)], *[none.alias(x) for x in extra])
    wide = keyed.unionByName(agree)
    if complete is not None:
        a, b, names = complete
        both = a.select(*names, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
            b.select(*names, F.lit(0).alias("_a"), F.lit(1).alias("_b"))).groupBy(*names).agg(
            F.sum("_a").alias("_x"), F.sum("_b").alias("_y"))
        x, y = F.col("_x"), F.col("_y")
        weight = F.when((x > 0) & (y > 0), x * y).otherwise(x + y)
        wide = wide.unionByName(both.select(
            F.lit(1).alias("_tag"), F.lit(None).cast("string").alias("_file"), *[none.alias(m) for m in sums],
            weight.alias("w"), *[F.when(F.col(m).isNull(), weight).otherwise(0).alias(f"z{i}")
                                 for i, m in enumerate(cols)]))
    return wide.groupBy("_tag", "_file").agg(*[F.sum(x).alias(x) for x in sums + extra])


def file_table(measures: DataFrame, cols: Sequence[str], by: str = "file_name") -> DataFrame:
    """The wide table per baseline file of ``file_level_accuracy``, from ``file_measures``."""
    of = measures.where((F.col("_tag") == 0) & F.col("_file").isNotNull() & F.col("total_rows").isNotNull())
    return of.select(F.col("_file").alias(by), "total_rows", *[F.coalesce(m, F.lit(0)).alias(m) for m in FILE_LEVEL_ISSUES],
                     *[F.col(f"m{i}").alias(c) for i, c in enumerate(cols)])


def issue_table(measures: DataFrame, cols: Sequence[str], parity: bool = False) -> DataFrame:
    """The issue summary (A17) from ``file_measures`` (with ``complete``): one grouped sum over its few rows."""
    issues = [(m, F.coalesce(m, F.lit(0)), F.lit(None).cast("bigint")) for m in FILE_LEVEL_ISSUES]
    issues += [(c, F.col(f"m{i}"), F.col(f"z{i}")) for i, c in enumerate(cols)]
    listed = (F.col("_tag") == 0) & F.col("_file").isNotNull() & F.col("total_rows").isNotNull()
    each = F.explode(F.array(*[F.struct(
        F.lit(name).alias("issue_type"), F.when(listed, errors).alias("e"), z.alias("z"),
        (F.col("duplicate_rows") if name == "duplicate_rows" else F.lit(None).cast("bigint")).alias("dup"))
        for name, errors, z in issues]))
    long = measures.select(listed.alias("listed"), F.when(listed, F.col("total_rows")).alias("t"), "w", each.alias("x")).select(
        "listed", "t", "w", "x.*")
    e, t = F.sum("e").cast("double"), F.sum("t").cast("double")
    hit = F.col("listed") & (F.col("e") > 0)
    if parity:
        hit = hit & ((F.lit(100.0) - F.col("e") / F.col("t") * 100) != 0)
    field = ~F.col("issue_type").isin(*FILE_LEVEL_ISSUES)
    g = long.groupBy("issue_type").agg(
        F.round(F.lit(100.0) - e / t * 100, 2).alias("accuracy"), F.count_if(hit).alias("files_affected"),
        (F.count_if(F.col("listed") & F.col("e").isNull()) / F.count_if("listed") * 100).alias("pct_missing"),
        (F.lit(100) - F.round(F.sum("z").cast("double") / F.sum("w").cast("double") * 100, 2)).alias("_pct"),
        F.coalesce(F.sum("dup"), F.lit(0)).cast("double").alias("_dup"))
    return g.select("issue_type", F.when(field, F.lit("Field")).otherwise(F.lit("File")).alias("issue_level"), "accuracy",
                    "files_affected", "pct_missing", F.when(field, F.col("_pct")).when(
                        F.col("issue_type") == "duplicate_rows", F.col("_dup")).alias("pct_incorrect"))


def run_totals(state: DataFrame, baseline_rows: DataFrame) -> DataFrame:
    """Matched rows, candidate rows not in the baseline, baseline rows left over.

    One aggregate over what became of the candidate rows (``ReconcileResult.state``) and one count of the baseline:
    the rows left over are those that no pair consumed.
    """
    of_state = state.agg(F.count_if(F.col("state") == "matched").alias("matched"),
                         F.count_if(F.col("state") != "matched").alias("left_only"),
                         (-F.count("consumed_id")).alias("right_only")).unpivot(
        [], ["matched", "left_only", "right_only"], "metric", "value")
    baseline = baseline_rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit("right_only").alias("metric"), "value")
    return of_state.unionByName(baseline).groupBy("metric").agg(F.sum("value").alias("value"))


def key_quality(df: DataFrame, key: str, side: str = "left") -> DataFrame:
    """Keys occurring more than once, and blank keys, with their row counts (K4)."""
    blank = F.col(key).isNull() | (strip(F.col(key)) == "")
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return g.where((F.col("n") > 1) | blank).select(F.lit(side).alias("side"), F.col(key).alias("key"), "n",
                                                    blank.alias("is_blank"))


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys that hold more than ``share`` of the rows, with their exact counts: (key, n). NULL keys don't count (K4).

    One pass of Misra-Gries, ``2 / share`` counters a task; the tasks' tables merge in rounds, ``MERGED`` tables a task,
    by adding counters. Whenever more counters are held, all are lowered by the next largest: each lowering by ``d`` takes
    more than ``d * 2 / share`` off all counters together, so no key loses more than half the share of all rows, however
    tables are merged, and every key over the share is found. The keys found, ``2 / share`` at most, are broadcast and
    counted exactly in a second scan.
    """
    k = int(2 / share) + 1
    text = df.select(F.col(key).cast("string").alias("k")).where(F.col("k").isNotNull())

    def scan(batches):
        top = Counters(k)
        for b in batches:
            got = b.column(0).value_counts()
            top.add(zip(got.field(0).to_pylist(), got.field(1).to_pylist()))
        yield top.table()

    def merge(batches):
        top = Counters(k)
        for b in batches:
            top.add(zip(*(c.to_pylist() for c in b.columns)))
        yield top.table()

    tables = text.mapInArrow(scan, "k string, n bigint")
    parts = tables.rdd.getNumPartitions()
    while parts > 1:
        parts = -(-parts // MERGED)
        tables = tables.repartition(parts).mapInArrow(merge, "k string, n bigint")
    found = tables.select(F.col("k").alias("_mk"))
    exact = text.join(F.broadcast(found), F.col("k") == F.col("_mk"), "left_semi").groupBy("k").agg(
        F.count(F.lit(1)).alias("n"))
    return exact.where(F.col("n") > share * text.count()).select(F.col("k").alias("key"), "n")


# Tables of counters that one task merges.
MERGED = 64


class Counters:
    """Misra-Gries: ``k`` counters that hold every key of more than 1 / (k + 1) of what was added."""

    def __init__(self, k: int):
        self.k, self.n = k, {}

    def add(self, counts) -> None:
        for key, c in counts:
            self.n[key] = self.n.get(key, 0) + c
            if len(self.n) >= 4 * self.k:
                self.shrink()
        self.shrink()

    def shrink(self) -> None:
        if len(self.n) > self.k:
            less = sorted(self.n.values(), reverse=True)[self.k]
            self.n = {key: c - less for key, c in self.n.items() if c > less}

    def table(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(self.n), pa.string()), pa.array(list(self.n.values()), pa.int64())],
                                          names=["k", "n"])


def baseline_coverage(pl: DataFrame, gt: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per candidate group (file, category, ...): does the baseline hold that group."""
    by = list(by)
    p = pl.select(*by).distinct()
    g = gt.select(*by).distinct().withColumn("has_baseline", F.lit(True))
    cond = None
    for c in by:
        e = p[c].eqNullSafe(g[c])
        cond = e if cond is None else cond & e
    return (p.join(g, cond, "left").select(*[p[c] for c in by], F.coalesce(g["has_baseline"], F.lit(False))
                                          .alias("has_baseline")))

"""Greedy one-to-one reconciliation of a candidate table against a baseline.

Semantics (per key; keys never interact):
  1. left rows are taken in ``order_by`` order (NULLs last, ``row_id`` breaks ties);
  2. candidates are baseline rows with the same key that are not consumed yet;
  3. none -> the left row is left-only;
  4. otherwise the first candidate (baseline order) with the fewest differing columns is *matched* and its diff
     list reported;
  5. the *last* candidate with that same diff list is *consumed*;
  6. unconsumed baseline rows are right-only.
With ``consume_exact=False`` a sole remaining candidate that is exactly equal (and holds no NULL) is matched but not
consumed, so it stays available (and ends up right-only) -- the database variant's behaviour.

Plan. Inputs are derived once. Keys are counted (rows on each side), every row is routed by its key's shape, and the
routed rows are written as Parquet to the shared folder, a folder for each side and shape, so that a branch reads its own
rows and columns only:
  0 x m / n x 0   anti sets, no pairing;
  1 x 1           equi-join on key;
  1 x m           equi-join, an exchange on the baseline row, then a two-level aggregate (key, diff) -> key; the
                  exchange frees the join's partitions, so AQE may split a hot key, and aggregation is partial;
  n x 1           the first left row (a min aggregate) takes the single baseline row;
  n x m           shuffle by key, sort by (key, side, order), and stream each partition through ``mapInPandas``:
                  baseline rows of a key arrive first and are kept as value classes (identical rows collapse);
                  left rows then stream past that state. Only one key's baseline rows are held at a time, besides
                  ``CACHE_BYTES`` of profiles, and no pair table is built. A key is one task;
  hot n x m       keys of more than ``hot_pairs`` row pairs: rows are looked up in indexes by the columns that agree, not
                  compared one by one (``hot_keys``).
All paths compare cells in one form (``cells.cell``), and what became of each left row is written once (``state``):
pairs, left-only and right-only rows and all totals read it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recheck.functions.cells import cell, cell_text, cell_type, comparable, diff_expr, order_struct, plain_text, strip
from recheck.operators import hot_keys
from recheck.session import Scratch, guard

# The streamed matchers run in Python workers: ship their code with the task (by value), so executors need no installed
# copy of the package.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    for _m in (__name__, hot_keys.__name__):
        _cloudpickle.register_pickle_by_value(_sys.modules[_m])
except Exception:  # noqa: BLE001 -- older cloudpickle: the package must then be importable on executors
    pass


# Row pairs of a key from which on it takes the path for hot keys: where that tries masks (``hot_keys.LATTICE``), and
# where it lists them first.
HOT_PAIRS = 40_000
HOT_PAIRS_LISTED = 25_000_000
LEFT, RIGHT = 0, 1
# Shapes of keys: the folders of the routed rows.
ALONE, ONE_ONE, ONE_MANY, MANY_ONE, MANY_MANY, HOT = range(6)


@dataclass
class ReconcileResult:
    pairs: DataFrame       # row_id, key, matched_id, consumed_id, diff_columns array<string>, n_diff
    left_only: DataFrame   # row_id, key, reason ('no_key' | 'used_up')
    right_only: DataFrame  # row_id, key
    compared: list
    routed: DataFrame | None   # every row of both sides: _side, _shape, _k, _id, cells, carried columns
    state: DataFrame | None    # every left row: row_id, key, state, matched_id, consumed_id, diff_columns, n_diff, shape
    carried: list
    scratch: Scratch

    def with_left(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """``df`` (row_id, key, ...) with carried left columns, joined to the routed rows on key and id."""
        left = self.routed.where(F.col("_side") == LEFT).select(
            F.col("_k").cast(df.schema["key"].dataType).alias("key"), F.col("_id").alias("row_id"),
            *[F.col(f"_a{self.carried.index(c)}").alias(c) for c in cols])
        return df.join(left, ["key", "row_id"])

    def cell_diffs(self) -> DataFrame:
        """(row_id, matched_id, column, left_value, right_value) of every differing cell of the matched pairs (D3).

        Cells are those that were compared, as text, NULL as 'nan'. 1 x 1 keys are joined again, on the key alone; of the
        others only rows of pairs that differ are looked up.
        """
        n = len(self.compared)
        cells = [f"_c{i}" for i in range(n)]

        def side(which: int, name: str, shapes) -> DataFrame:
            return self.routed.where((F.col("_side") == which) & F.col("_shape").isin(*shapes)).select(
                "_k", "_id", *cells).alias(name)

        def rows(j: DataFrame) -> DataFrame:
            each = F.filter(F.array(*[F.when(~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")), F.struct(
                F.lit(self.compared[i]).alias("column"), cell_text(F.col(f"l.{c}")).alias("left_value"),
                cell_text(F.col(f"r.{c}")).alias("right_value"))) for i, c in enumerate(cells)]),
                lambda x: x.isNotNull())
            return j.select(F.col("l._id").alias("row_id"), F.col("r._id").alias("matched_id"), each.alias("_e")).where(
                F.size("_e") > 0).select("row_id", "matched_id", F.explode("_e").alias("_s")).select(
                "row_id", "matched_id", "_s.*")

        one = rows(side(LEFT, "l", [ONE_ONE]).join(side(RIGHT, "r", [ONE_ONE]), F.col("l._k") == F.col("r._k")))
        rest = [ONE_MANY, MANY_ONE, MANY_MANY, HOT]
        p = self.state.where((F.col("n_diff") > 0) & F.col("shape").isin(*rest)).select(
            F.col("key").alias("_pk"), F.col("row_id").alias("_pl"), F.col("matched_id").alias("_pr"))
        found = (p.join(side(LEFT, "l", rest), (F.col("_pk") == F.col("l._k")) & (F.col("_pl") == F.col("l._id")))
                 .join(side(RIGHT, "r", rest), (F.col("_pk") == F.col("r._k")) & (F.col("_pr") == F.col("r._id"))))
        return one.unionByName(rows(found)) if n else rows(found)

    def release(self) -> None:
        """Lets go of all results and removes the files they read."""
        self.pairs = self.left_only = self.right_only = self.routed = self.state = None
        self.scratch.drop()


def _prep(df, other, key, row_id, order_by, cols, mode, trim, raw, side, carry):
    """Key, id and order of a side, and each compared cell in the one form (``cells.cell``) in which any path below
    compares cells. ``carry``: name of the column (of the left side) -> its type."""
    if not isinstance(df.schema[row_id].dataType, T.IntegralType):
        raise TypeError(f"row id {row_id!r} must be a whole number, not {df.schema[row_id].dataType.simpleString()}")
    kinds = {c: df.schema[c].dataType for c in cols}
    cells = {c: strip(c) if trim and isinstance(kinds[c], T.StringType) else F.col(c) for c in cols}
    sel = [F.lit(side).alias("_side"), F.col(key).cast("string").alias("_k"), F.col(row_id).cast("long").alias("_id"),
           order_struct(order_by, row_id).alias("_o")]
    sel += [(F.col(c) if side == LEFT else F.lit(None).cast(kind)).alias(f"_a{i}")
            for i, (c, kind) in enumerate(carry.items())]
    sel += [cell(cells[c], kinds[c], other.schema[c].dataType, mode).alias(f"_c{i}") for i, c in enumerate(cols)]
    if raw:
        sel += [plain_text(cells[c], kinds[c]).alias(f"_x{i}") for i, c in enumerate(cols)]
    return df.select(*sel)


class HotKeyError(ValueError):
    """A key has more row pairs than the caller allows."""


def _check_pairs(counts: DataFrame, max_pairs: int) -> None:
    over = counts.where(F.col("_nl") * F.col("_nr") > max_pairs).orderBy((F.col("_nl") * F.col("_nr")).desc()).limit(
        5).collect()
    if over:
        raise HotKeyError(f"keys of more than {max_pairs} row pairs: " + ", ".join(
            f"{r['_k']!r} ({r['_nl']} x {r['_nr']} rows)" for r in over))


def _names_from_idx(idx: Column, cols) -> Column:
    names = F.array(*[F.lit(c) for c in cols]) if cols else F.array().cast("array<string>")
    return F.transform(idx, lambda i: F.element_at(names, i + 1))


def reconcile(left: DataFrame, right: DataFrame, key: str, cols: Sequence[str] | None = None,
              order_by: Sequence[str] = (), row_id: str = "row_id", right_row_id: str | None = None,
              right_order_by: Sequence[str] | None = None, mode: str = "exact", consume_exact: bool = True,
              trim_left: bool = False, fast_paths: bool = True, carry: Sequence[str] = (),
              hot_pairs: int | None = None, max_pairs: int | None = None, rescan: bool = False) -> ReconcileResult:
    """Greedy 1:1 matching of ``left`` (candidate) rows to ``right`` (baseline) rows on ``key``.

    ``cols`` are the compared columns (default: common columns minus key and row id); ``mode`` 'exact' or 'ci'.
    ``carry``: left columns kept with the routed rows, for ``ReconcileResult.with_left``. ``hot_pairs``: keys of more row
    pairs take the path for hot keys (same results; default ``HOT_PAIRS``). ``max_pairs``: a guard; a key of more row pairs raises
    ``HotKeyError`` before anything is matched (one more job, over the keys). ``rescan``: the inputs are plain scans, to
    be read twice rather than derived once and written.
    """
    guard(left.sparkSession)
    right_row_id = right_row_id or row_id
    right_order_by = list(right_order_by) if right_order_by is not None else list(order_by)
    if cols is None:
        skip = {key, row_id, right_row_id}
        cols = [c for c in left.columns if c in right.columns and c not in skip]
    cols = list(cols)
    C = len(cols)
    if hot_pairs is None:
        hot_pairs = HOT_PAIRS if C <= hot_keys.LATTICE else HOT_PAIRS_LISTED
    raw = (not consume_exact) and mode != "exact"
    kept = {c: left.schema[c].dataType for c in carry}
    L = _prep(left, right, key, row_id, list(order_by), cols, mode, trim_left, raw, LEFT, kept)
    R = _prep(right, left, key, right_row_id, right_order_by, cols, mode, False, raw, RIGHT, kept)
    lv = {c: F.col(f"l._c{i}") for i, c in enumerate(cols)}
    rv = {c: F.col(f"r._c{i}") for i, c in enumerate(cols)}

    scratch = Scratch(left.sparkSession, "reconcile")
    both = L.unionByName(R)
    if not rescan:
        both = scratch.written(both, "prepared")
    # Rows per key on each side: one partial aggregate over both, one row per key.
    counts = (both.select("_k", "_side").where(F.col("_k").isNotNull()).groupBy("_k")
              .agg(F.count_if(F.col("_side") == LEFT).alias("_nl"), F.count_if(F.col("_side") == RIGHT).alias("_nr")))
    if max_pairs is not None:
        _check_pairs(counts, max_pairs)
    nl, nr = F.col("_nl"), F.col("_nr")
    several = F.when(nl * nr > hot_pairs, F.lit(HOT)).otherwise(F.lit(MANY_MANY)) if C else F.lit(MANY_MANY)
    if not fast_paths:
        shape = F.when(nl.isNull() | (nl == 0) | (nr == 0), ALONE).otherwise(several)
    else:
        shape = (F.when(nl.isNull() | (nl == 0) | (nr == 0), ALONE).when((nl == 1) & (nr == 1), ONE_ONE)
                 .when(nl == 1, ONE_MANY).when(nr == 1, MANY_ONE).otherwise(several))
    # Every row of both sides is routed by its key's shape with one shuffle join against the counts (a hot key's
    # partition is split by AQE; the counts have one row per key) and written once: each branch then reads and shuffles
    # only its own rows, and a lost executor costs a re-read, not a re-run. Pre-partitioning by key is avoided on
    # purpose: it would send a hot key to a single task.
    routed = scratch.written(
        both.join(counts.withColumnRenamed("_k", "_ck"), F.col("_k") == F.col("_ck"), "left")
        .withColumn("_shape", shape).drop("_ck", "_nl", "_nr"), "rows", by=("_side", "_shape"))
    if not rescan:
        scratch.remove("prepared")

    def of(side: int, *shapes: int) -> DataFrame:
        return routed.where((F.col("_side") == side) & F.col("_shape").isin(*shapes))

    def exact_row(l_pre: str, r_pre: str) -> Column:
        """Whole-row equality that the 'not consumed' rule needs: equal cells and no NULL on the baseline row."""
        conds = []
        for i in range(C):
            rc = F.col(f"{r_pre}._c{i}")
            if raw:
                conds.append(F.col(f"{l_pre}._x{i}").eqNullSafe(F.col(f"{r_pre}._x{i}")) & F.col(f"{r_pre}._x{i}").isNotNull())
            else:
                conds.append(F.col(f"{l_pre}._c{i}").eqNullSafe(rc) & rc.isNotNull())
        out = F.lit(True)
        for c in conds:
            out = out & c
        return out

    pair_cols = ["row_id", "key", "matched_id", "consumed_id", "diff_columns", "n_diff"]
    none = [F.lit(None).cast(t).alias(c) for c, t in (("matched_id", "long"), ("consumed_id", "long"),
                                                      ("diff_columns", "array<string>"))]
    parts = []  # every left row: row_id, key, matched_id, consumed_id, diff_columns, state, shape

    def pairs_of(df: DataFrame, shape: int) -> None:
        parts.append(df.withColumn("state", F.lit("matched")).withColumn("shape", F.lit(shape)))

    def without(df: DataFrame, shape: int) -> None:
        parts.append(df.select(F.col("_id").alias("row_id"), F.col("_k").alias("key"), *none, F.lit(
            "no_key" if shape == ALONE else "used_up").alias("state"), F.lit(shape).alias("shape")))

    # shapes that no left row has are left out of the plan: their folders are not there
    there = {s for s in range(HOT + 1) if scratch.has(f"rows/_side={LEFT}/_shape={s}")}
    if ONE_ONE in there:
        l11, r11 = of(LEFT, ONE_ONE).alias("l"), of(RIGHT, ONE_ONE).alias("r")
        d11 = diff_expr(lv, rv, cols)
        consumed11 = F.col("r._id") if consume_exact else F.when(~exact_row("l", "r"), F.col("r._id"))
        p11 = l11.join(r11, F.col("l._k") == F.col("r._k")).select(
            F.col("l._id").alias("row_id"), F.col("l._k").alias("key"), F.col("r._id").alias("matched_id"),
            consumed11.alias("consumed_id"), d11.alias("diff_columns"))
        pairs_of(p11, ONE_ONE)
    if ONE_MANY in there:
        # 1 x m: every candidate of the single left row, then (key, diff) groups -> best group per key.
        l1m, r1m = of(LEFT, ONE_MANY).alias("l"), of(RIGHT, ONE_MANY).alias("r")
        cand = l1m.join(r1m, F.col("l._k") == F.col("r._k")).select(
            F.col("l._k").alias("_k"), F.col("l._id").alias("_lid"),
            F.struct(F.col("r._o").alias("o"), F.col("r._id").alias("id")).alias("_ro"),
            diff_expr(lv, rv, cols).alias("_d")).repartition("_ro.id")  # else the aggregate keeps the join's partitions
        by_diff = cand.groupBy("_k", "_lid", "_d").agg(F.min("_ro").alias("_first"), F.max("_ro").alias("_last"))
        best = by_diff.groupBy("_k", "_lid").agg(F.min_by(
            F.struct("_d", F.col("_first.id").alias("mid"), F.col("_last.id").alias("cid")),
            F.struct(F.size("_d"), F.col("_first.o"))).alias("_b"))
        p1m = best.select(F.col("_lid").alias("row_id"), F.col("_k").alias("key"),
                          F.col("_b.mid").alias("matched_id"), F.col("_b.cid").alias("consumed_id"),
                          F.col("_b._d").alias("diff_columns"))
        pairs_of(p1m, ONE_MANY)
    if MANY_ONE in there:
        # n x 1: the first left row takes the single baseline row; the rest find nothing.
        ln1, rn1 = of(LEFT, MANY_ONE), of(RIGHT, MANY_ONE).alias("r")
        if consume_exact:
            vc = [f"_c{i}" for i in range(C)]
            first = ln1.groupBy("_k").agg(F.min(F.struct("_o", "_id", *vc)).alias("_f")).select(
                "_k", "_f._id", *[F.col(f"_f.{c}").alias(c) for c in vc])
            pn1 = first.alias("l").join(rn1, F.col("l._k") == F.col("r._k")).select(
                F.col("l._id").alias("row_id"), F.col("l._k").alias("key"), F.col("r._id").alias("matched_id"),
                F.col("r._id").alias("consumed_id"), diff_expr(lv, rv, cols).alias("diff_columns"))
            without(ln1.join(first.select("_k", "_id"), ["_k", "_id"], "left_anti"), MANY_ONE)
        else:
            # Rows match until the first one that is not exactly equal consumes the baseline row.
            j = ln1.alias("l").join(rn1, F.col("l._k") == F.col("r._k")).select(
                F.col("l._k").alias("_k"), F.col("l._id").alias("_id"), F.col("l._o").alias("_o"),
                F.col("r._id").alias("_rid"), diff_expr(lv, rv, cols).alias("_d"),
                exact_row("l", "r").alias("_ex")).repartition("_id")
            stop = j.where(~F.col("_ex")).groupBy("_k").agg(F.min(F.struct("_o", "_id")).alias("_t"))
            jt = j.join(stop, "_k", "left")
            take = F.col("_t").isNull() | (F.struct("_o", "_id") <= F.col("_t"))
            is_t = F.col("_t").isNotNull() & (F.struct("_o", "_id") == F.col("_t"))
            pn1 = jt.where(take).select(F.col("_id").alias("row_id"), F.col("_k").alias("key"),
                                        F.col("_rid").alias("matched_id"),
                                        F.when(is_t, F.col("_rid")).alias("consumed_id"),
                                        F.col("_d").alias("diff_columns"))
            without(jt.where(~take), MANY_ONE)
        pairs_of(pn1, MANY_ONE)
    if MANY_MANY in there:
        parts.append(_named(_greedy_stream(_as_text(of(LEFT, MANY_MANY), C), _as_text(of(RIGHT, MANY_MANY), C), C,
                                           consume_exact, raw), cols, MANY_MANY))
    if HOT in there:
        parts.append(_named(hot_keys.matched(_hashed(of(LEFT, HOT), C, raw), _hashed(of(RIGHT, HOT), C, raw), C,
                                             consume_exact), cols, HOT))
    if ALONE in there or not parts:
        without(of(LEFT, ALONE), ALONE)
    state = parts[0]
    for p in parts[1:]:
        state = state.unionByName(p)
    # Every left row with what became of it: matched once, written once, read by all outputs.
    state = scratch.written(state.withColumn("n_diff", F.size("diff_columns")), "state")

    kind = left.schema[key].dataType

    def typed(df):
        return df if isinstance(kind, T.StringType) else df.withColumn("key", F.col("key").cast(kind))

    pairs = state.where(F.col("state") == "matched").select(*pair_cols)
    left_only = state.where(F.col("state") != "matched").select("row_id", "key", F.col("state").alias("reason"))
    consumed = pairs.where(F.col("consumed_id").isNotNull()).select(
        F.col("key").alias("_k"), F.col("consumed_id").alias("_id"))
    right_only = (of(RIGHT, ALONE).select("_k", "_id")
                  .unionByName(routed.where((F.col("_side") == RIGHT) & (F.col("_shape") != ALONE)).select("_k", "_id")
                               .join(consumed, ["_k", "_id"], "left_anti"))
                  .select(F.col("_id").alias("row_id"), F.col("_k").alias("key")))
    return ReconcileResult(pairs=typed(pairs), left_only=typed(left_only), right_only=typed(right_only), compared=cols,
                           routed=routed, state=state, carried=list(kept), scratch=scratch)


def _as_text(rows: DataFrame, n: int) -> DataFrame:
    """Cells as the one text (``comparable``) that stands for each: Python sees no typed cell."""
    kinds = {f"_c{i}": rows.schema[f"_c{i}"].dataType for i in range(n)}
    return rows.withColumns({c: comparable(c, k, k) for c, k in kinds.items() if not isinstance(k, T.StringType)})


def _hashed(rows: DataFrame, n: int, raw: bool) -> DataFrame:
    """(_k, _id, _o, _h, _xn, _xh): hashes of the cells; of the raw cells, whether any is NULL and one hash."""
    cells = [F.col(f"_c{i}") for i in range(n)]
    plain = [F.col(f"_x{i}") for i in range(n)] if raw else cells
    any_null = F.lit(False)
    for c in plain:
        any_null = any_null | c.isNull()
    return rows.select("_k", "_id", "_o", hot_keys.packed_hashes(cells).alias("_h"), any_null.alias("_xn"),
                       (F.xxhash64(*plain) if raw else F.lit(0).cast("long")).alias("_xh"))


def _named(out: DataFrame, cols, shape: int) -> DataFrame:
    """What became of left rows, from a matcher's (_k, _lid, _mid, _cid, _d) rows: one projection, so that the matcher
    runs once."""
    return out.select(F.col("_lid").alias("row_id"), F.col("_k").alias("key"), F.col("_mid").alias("matched_id"),
                      F.col("_cid").alias("consumed_id"), _names_from_idx(F.col("_d"), cols).alias("diff_columns"),
                      F.when(F.col("_mid").isNull(), F.lit("used_up")).otherwise(F.lit("matched")).alias("state"),
                      F.lit(shape).alias("shape"))


# ---------------------------------------------------------------------------------------------------------------
# n x m keys: sort-and-stream greedy.

_NULL = object()


class _KeyState:
    """Baseline rows of one key, collapsed into value classes; availability is a prefix count per class.

    Because the consumed row is always the *last* available one of some class, each class's available rows stay a
    prefix of its rows in baseline order: the class's first row (the matched id) never changes while it has rows.
    Diff lists are bit masks over the compared columns, cached per distinct left value tuple. Keys with few value
    classes are scanned in plain Python; larger ones use numpy vectors over the classes.
    """

    SMALL = 24
    # Bytes of class profiles kept for left tuples that come again; beyond it they are computed anew.
    CACHE_BYTES = 32 << 20

    __slots__ = ("key", "C", "codes", "rows_id", "rows_raw", "cls_index", "cls_codes", "cls_pos", "ready", "n",
                 "k", "firstpos", "lastpos", "avail", "cache", "big", "ok", "np_last", "N", "R", "np_first", "w")

    def __init__(self, key, C):
        self.key, self.C = key, C
        self.codes = [dict() for _ in range(C)]
        self.rows_id, self.rows_raw = [], []
        self.cls_index, self.cls_codes, self.cls_pos = {}, [], []
        self.ready = False
        self.cache = {}

    def add_right(self, rid, vals, raw):
        """``vals``: cell values with NULL/NaN already replaced by the ``_NULL`` marker (see ``_batch_rows``)."""
        t = []
        for d, v in zip(self.codes, vals):
            c = d.get(v)
            if c is None:
                c = d[v] = len(d)
            t.append(c)
        t = tuple(t)
        ci = self.cls_index.get(t)
        if ci is None:
            ci = self.cls_index[t] = len(self.cls_codes)
            self.cls_codes.append(t)
            self.cls_pos.append([])
        self.cls_pos[ci].append(len(self.rows_id))
        self.rows_id.append(rid)
        self.rows_raw.append(raw)

    def finish(self):
        self.n = n = len(self.cls_codes)
        self.N = len(self.rows_id) + 1
        self.k = [len(p) for p in self.cls_pos]
        self.firstpos = [p[0] for p in self.cls_pos]
        self.lastpos = [p[-1] for p in self.cls_pos]
        self.avail = len(self.rows_id)
        self.big = n > self.SMALL
        if self.big:
            self.ok = np.ones(n, dtype=bool)
            self.np_last = np.array(self.lastpos, dtype=np.int64)
            self.np_first = np.array(self.firstpos, dtype=np.int64)
            self.R = np.array(self.cls_codes, dtype=np.int64).reshape(n, self.C)
            self.w = (np.left_shift(np.int64(1), np.arange(self.C, dtype=np.int64)) if self.C <= 62
                      else np.array([1 << i for i in range(self.C)], dtype=object))
        self.ready = True

    def _take(self, ci):
        self.k[ci] -= 1
        self.avail -= 1
        kk = self.k[ci]
        last = self.cls_pos[ci][kk - 1] if kk > 0 else -1
        self.lastpos[ci] = last
        if self.big:
            self.np_last[ci] = last
            if kk == 0:
                self.ok[ci] = False
        return self.rows_id[self.cls_pos[ci][kk]]

    def _profile(self, t):
        """Per class: diff mask and ordering score (diff count, then first row) against left tuple ``t``."""
        N = self.N
        if self.big:
            d = self.R != np.asarray(t, dtype=np.int64)
            masks = d.astype(np.int64 if self.C <= 62 else object) @ self.w
            return masks, d.sum(axis=1) * N + self.np_first
        masks, scores = [], []
        for ci, codes in enumerate(self.cls_codes):
            m = 0
            s = 0
            for i, (a, b) in enumerate(zip(codes, t)):
                if a != b:
                    m |= 1 << i
                    s += 1
            masks.append(m)
            scores.append(s * N + self.firstpos[ci])
        return masks, scores

    def match(self, vals, raw, consume_exact):
        """(matched_id, consumed_id or None, diff index list), or None when no candidate is left."""
        if not self.ready:
            self.finish()
        if self.avail == 0:
            return None
        t = tuple([d.get(v, -1) for d, v in zip(self.codes, vals)])
        ci = self.cls_index.get(t)
        if ci is not None and self.k[ci] > 0:
            # identical class: zero diffs, the only class with the empty diff list
            best, c, m = ci, ci, 0
        else:
            prof = self.cache.get(t)
            if prof is None:
                prof = self._profile(t)
                if (len(self.cache) + 1) * self.n * 16 > self.CACHE_BYTES:
                    self.cache.clear()
                self.cache[t] = prof
            masks, scores = prof
            if self.big:
                best = int(np.argmin(np.where(self.ok, scores, np.iinfo(np.int64).max)))
                m = masks[best]
                same = np.flatnonzero(self.ok & (masks == m))
                c = int(same[0]) if len(same) == 1 else int(same[np.argmax(self.np_last[same])])
                m = int(m)
            else:
                k = self.k
                best, bs = -1, None
                for j in range(self.n):
                    if k[j] and (bs is None or scores[j] < bs):
                        best, bs = j, scores[j]
                m = masks[best]
                c, cl = best, self.lastpos[best]
                for j in range(self.n):
                    if k[j] and masks[j] == m and self.lastpos[j] > cl:
                        c, cl = j, self.lastpos[j]
        matched = self.rows_id[self.cls_pos[best][0]]
        diff = [i for i in range(self.C) if (m >> i) & 1] if m else []
        if not consume_exact and self.avail == 1 and not diff:
            pos = self.cls_pos[c][self.k[c] - 1]
            rcodes = self.cls_codes[c]
            if raw is None:
                exact = all(self.codes[i].get(_NULL, -2) != rcodes[i] for i in range(self.C))
            else:
                r_raw = self.rows_raw[pos]
                exact = not any(x is _NULL for x in r_raw) and tuple(raw) == r_raw
            if exact:
                return matched, None, diff
        return matched, self._take(c), diff


def _batch_rows(pdf: pd.DataFrame, cols) -> list:
    """Row tuples of ``cols`` with NULL/NaN replaced by the ``_NULL`` marker, vectorised per column."""
    out = []
    for c in cols:
        a = pdf[c].to_numpy(dtype=object)
        m = pd.isna(pdf[c]).to_numpy()
        if m.any():
            a = a.copy()
            a[m] = _NULL
        out.append(a.tolist())
    return list(zip(*out)) if out else [()] * len(pdf)


def _greedy_stream(gl: DataFrame, gr: DataFrame, C: int, consume_exact: bool, raw: bool) -> DataFrame:
    vcols = [f"_c{i}" for i in range(C)]
    xcols = [f"_x{i}" for i in range(C)] if raw else []
    keep = ["_k", "_side", "_id"] + vcols + xcols
    both = (gr.withColumn("_side", F.lit(0)).select(*keep, "_o")
            .unionByName(gl.withColumn("_side", F.lit(1)).select(*keep, "_o")))
    # Shuffle on a computed hash of the key: no child partitioning can claim to satisfy it, so the exchange that
    # brings both sides of a key into one task is never elided.
    streamed = (both.withColumn("_p", F.xxhash64("_k")).repartition("_p")
                .sortWithinPartitions("_k", "_side", "_o").select(*keep))
    schema = "_k string, _lid long, _mid long, _cid long, _d array<int>"

    def run(batches):
        st = None
        for pdf in batches:
            ks = pdf["_k"].tolist()
            side = pdf["_side"].tolist()
            ids = pdf["_id"].tolist()
            rows = _batch_rows(pdf, vcols)
            raws = _batch_rows(pdf, xcols) if raw else None
            ok_, ol, om, oc, od = [], [], [], [], []
            for j in range(len(ks)):
                k = ks[j]
                if st is None or st.key != k:
                    st = _KeyState(k, C)
                row = rows[j]
                rw = raws[j] if raw else None
                if side[j] == 0:
                    st.add_right(int(ids[j]), row, rw)
                    continue
                m = st.match(row, rw, consume_exact)
                ok_.append(k)
                ol.append(int(ids[j]))
                if m is None:
                    om.append(None); oc.append(None); od.append(None)  # noqa: E702
                else:
                    om.append(m[0]); oc.append(m[1]); od.append(m[2])  # noqa: E702
            if ol:
                yield pd.DataFrame({"_k": ok_, "_lid": ol, "_mid": pd.array(om, dtype="Int64"),
                                    "_cid": pd.array(oc, dtype="Int64"), "_d": od})

    return streamed.mapInPandas(run, schema)

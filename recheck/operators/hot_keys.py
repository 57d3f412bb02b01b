"""Greedy matching of one key's n x m rows without comparing n x m rows (J2, J3, W2 for keys of very many rows).

The greedy is sequential within a key. Let ``m`` be a mask (the set of differing columns) with the fewest differences
among those that still have a baseline row. Then the rows that agree with the left row in all columns outside of ``m``
and are still there have exactly this mask: any that agreed in more columns would have come first. So a mask's rows are
those of one bucket of an index over the columns outside of it. The first row over the level's buckets is matched; the
last of its bucket is consumed.

Cells become 64-bit hashes of their compared form (a key's row is never equal to another by accident but with a chance of
about n * n / 2 ** 65 a column).

Up to ``LATTICE`` columns, masks are tried, fewest differences first (``Standing``): no row is compared with all others,
so a key's work grows with its rows, times the masks tried, 2 ** columns at most. Of every column it is known how many
rows that are still there have each value: a value that none has differs in any case, one that all have agrees, and only
the other columns are tried. Where a level has more masks than a look at the rows still there costs, or the indexes do
not fit into ``index_bytes``, the left row is compared with all rows left: the result is exact in any case.

With more columns, the masks that occur are listed first. Comparing every left value class (rows with equal cells) with
every baseline value class is dealt to tasks; what stays sequential looks up a few numbers for each left row:

1. ``short_lists``: a key's left classes are dealt into groups of about ``GROUP``; the key's baseline classes stream past
   each group, a block at a time, in NumPy. Of every left class the distinct diff lists (bit masks over the columns) are
   kept that occur with any baseline class, fewest differences first, whole levels up to ``SHORT`` masks.
2. ``resolve``: one stream a key, baseline rows in their order, then left rows in theirs. Pointers from both ends of a
   bucket skip rows that are gone, each once. An index costs one sort of the key's baseline rows, is made when first asked for, and dropped when ``INDEX_BYTES``
   are reached. A left row whose list runs dry, because it was cut, is compared with all rows left: the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATTICE = 12        # compared columns up to which masks are tried, not listed
GROUP = 1024        # left classes that one task compares
BLOCK = 8192        # baseline classes compared at a time
SHORT = 512         # masks of a left class's list
INDEX_BYTES = 512 << 20
CLEARED = 8         # times that a key's indexes are dropped for room before its rows are compared instead
LISTED = 4 << 20    # masks kept unpacked for left classes that come again
_DENSE_BITS = 14    # up to so many columns, masks are marked in a table
_MIX = np.uint64(0x9E3779B97F4A7C15)


# -- masks ---------------------------------------------------------------------------------------------------------

def mask_bytes(columns: int) -> int:
    return (columns + 7) // 8


def pack(diff: np.ndarray) -> np.ndarray:
    """Rows of flags (rows, columns) as one bytes value a row."""
    packed = np.packbits(diff, axis=1)
    return np.ascontiguousarray(packed).view(f"V{packed.shape[1]}").ravel()


def flags(mask: bytes, columns: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(mask, np.uint8))[:columns].astype(bool)


class Masks:
    """The distinct masks of each of some left classes against the baseline classes seen so far."""

    def __init__(self, left: np.ndarray):
        self.left = left
        n, self.columns = left.shape
        self.dense = self.columns <= _DENSE_BITS
        if self.dense:
            self.seen = np.zeros((n, 1 << self.columns), bool)
            # codes within the group: a baseline value that no left class has differs from all
            self.known = [np.unique(left[:, j]) for j in range(self.columns)]
            self.codes = [np.searchsorted(k, left[:, j]).astype(np.int32) for j, k in enumerate(self.known)]
        else:
            self.sets = [set() for _ in range(n)]

    def add(self, right: np.ndarray) -> None:
        if not self.dense:
            for t, have in zip(self.left, self.sets):
                have.update(x.tobytes() for x in np.unique(pack(right != t)))
            return
        mask = np.zeros((len(self.left), len(right)), np.int16)
        for j, (known, code) in enumerate(zip(self.known, self.codes)):
            at = np.minimum(np.searchsorted(known, right[:, j]), len(known) - 1)
            own = np.where(known[at] == right[:, j], at, -1).astype(np.int32)
            mask |= (code[:, None] != own[None, :]).astype(np.int16) << j
        rows = np.arange(len(self.left))[:, None]
        self.seen[rows, mask] = True

    def lists(self, short: int) -> list[bytes]:
        """The masks of each left class one after the other, fewest differences first."""
        out, width = [], mask_bytes(self.columns)
        for i in range(len(self.left)):
            if self.dense:
                bits = np.flatnonzero(self.seen[i])[:, None] >> np.arange(self.columns) & 1
            else:
                raw = np.frombuffer(b"".join(sorted(self.sets[i])), np.uint8).reshape(-1, width)
                bits = np.unpackbits(raw, axis=1)[:, : self.columns]
            size = bits.sum(1)
            order = np.argsort(size, kind="stable")
            keep = len(order)
            if keep > short:  # whole levels only
                keep = int(np.searchsorted(size[order], size[order[short]]))
            packed = np.packbits(bits[order[:keep]].astype(np.uint8), axis=1)
            out.append(packed.tobytes())
        return out


def _codes(column: pa.Array, columns: int) -> np.ndarray:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[at[0]: at[-1]]
    return raw.view(">i8").astype(np.int64).reshape(-1, columns)


def packed_hashes(cells: list[Column]) -> Column:
    """Hashes of the cells, 8 bytes each, as one binary."""
    if not cells:
        return F.lit(b"")
    return F.concat(*[F.to_binary(F.lpad(F.hex(F.xxhash64(c)), 16, "0"), F.lit("hex")) for c in cells])


def short_lists(left: DataFrame, right: DataFrame, columns: int, group: int = GROUP, short: int = SHORT) -> DataFrame:
    """(_k, _h, _masks) of every left value class; ``left`` and ``right``: (_k, _h) of all rows of the keys."""
    lc, rc = left.select("_k", "_h").distinct(), right.select("_k", "_h").distinct()
    groups = lc.groupBy("_k").agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias("_groups"))
    of_group = F.pmod(F.xxhash64("_h"), F.col("_groups")).cast("int")
    dealt = (lc.join(groups, "_k").select("_k", of_group.alias("_g"), F.lit(0).alias("_side"), "_h")
             .unionByName(rc.join(groups, "_k").select(
                 "_k", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("_g"), F.lit(1).alias("_side"), "_h")))
    # A hash that no child partitioning can claim (see match._greedy_stream), and a number of partitions that adaptive
    # execution keeps: the work of a group is not its bytes.
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streamed = (dealt.withColumn("_p", F.xxhash64("_k", "_g")).repartition(n, "_p")
                .sortWithinPartitions("_k", "_g", "_side").select("_k", "_g", "_side", "_h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, raw, masks, waiting = None, [], None, []

        def flush() -> None:
            nonlocal masks, waiting
            if masks is None:
                masks = Masks(np.frombuffer(b"".join(raw), ">i8").astype(np.int64).reshape(len(raw), columns))
            if waiting:
                masks.add(np.frombuffer(b"".join(waiting), ">i8").astype(np.int64).reshape(len(waiting), columns))
                waiting = []

        def done() -> Iterator[pa.RecordBatch]:
            flush()
            got = masks.lists(short)
            for i in range(0, len(raw), 1024):
                part = got[i: i + 1024]
                yield pa.RecordBatch.from_arrays([pa.array([at[0]] * len(part), pa.string()), pa.array(
                    raw[i: i + 1024], pa.binary()), pa.array(part, pa.binary())], names=["_k", "_h", "_masks"])

        for b in batches:
            for k, g, side, h in zip(*(c.to_pylist() for c in b.columns)):
                if at != (k, g):
                    if at is not None:
                        yield from done()
                    at, raw, masks, waiting = (k, g), [], None, []
                if side == 0:
                    raw.append(h)
                else:
                    waiting.append(h)
                    if len(waiting) == BLOCK:
                        flush()
        if at is not None:
            yield from done()

    return streamed.mapInArrow(run, "_k string, _h binary, _masks binary")


# -- the sequence --------------------------------------------------------------------------------------------------

class Index:
    """Baseline rows of one key by their values in some columns: buckets of row numbers, ascending."""

    def __init__(self, codes: np.ndarray, which: np.ndarray):
        self.which = which
        h = self.hashed(codes)
        self.order = np.argsort(h, kind="stable").astype(np.int64)
        self.keys, start = np.unique(h[self.order], return_index=True)
        self.low = start.tolist()
        self.high = [*(start[1:] - 1).tolist(), len(h) - 1]
        self.bytes = 32 * len(h)

    def hashed(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), 17, np.uint64)
        for j in self.which:
            out = (out ^ codes[:, j].astype(np.uint64)) * _MIX
            out ^= out >> np.uint64(29)
        return out

    def buckets(self, codes: np.ndarray) -> list[int]:
        """The bucket of each left row, -1 where there is none."""
        h = self.hashed(codes)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, -1).tolist()


class Sequence:
    """Baseline rows of one key, and which of them are still there."""

    def __init__(self, ids: list[int], codes: np.ndarray, any_null: list[bool], raw: list[int], index_bytes: int):
        self.ids, self.codes, self.any_null, self.raw = ids, codes, any_null, raw
        self.there = bytearray(b"\x01") * len(ids)
        self.left = len(ids)
        self.room, self.indexes = index_bytes, {}
        self.lists, self.listed, self.known = {}, 0, {}
        self.scans = 0

    def levels(self, h: bytes, masks: bytes, width: int) -> list[tuple[int, list[bytes]]]:
        """(differences, masks) of a left class, the next level last; it gets shorter as rows go."""
        out = self.lists.get(h)
        if out is None:
            out = []
            for i in range(0, len(masks), width):
                m = self.known.setdefault(masks[i: i + width], masks[i: i + width])
                n = int.from_bytes(m, "big").bit_count()
                if not out or out[-1][0] != n:
                    out.append((n, []))
                out[-1][1].append(m)
            out.reverse()
            if self.listed > LISTED:
                self.lists.clear()
                self.listed = 0
            self.listed += len(masks) // width
            self.lists[h] = out
        return out

    def index(self, mask: bytes) -> Index:
        got = self.indexes.get(mask)
        if got is None:
            which = np.flatnonzero(~flags(mask, self.codes.shape[1]))
            got = Index(self.codes, which)
            if self.indexes and sum(i.bytes for i in self.indexes.values()) + got.bytes > self.room:
                self.indexes.clear()
            self.indexes[mask] = got
        return got

    def ends(self, index: Index, bucket: int) -> tuple[int, int] | None:
        """First and last row of a bucket that are still there."""
        low, high, order, there = index.low[bucket], index.high[bucket], index.order, self.there
        while low <= high and not there[order[low]]:
            low += 1
        while low <= high and not there[order[high]]:
            high -= 1
        index.low[bucket], index.high[bucket] = low, high
        return (int(order[low]), int(order[high])) if low <= high else None

    def consume(self, row: int) -> None:
        self.there[row] = 0
        self.left -= 1

    def scan(self, code: np.ndarray) -> tuple[bytes, int, int]:
        """(mask, matched row, consumed row) by comparing with every row that is still there."""
        self.scans += 1
        rows = np.flatnonzero(np.frombuffer(self.there, np.uint8))
        diff = self.codes[rows] != code
        first = int(diff.sum(1).argmin())
        same = np.flatnonzero((diff == diff[first]).all(1))
        return np.packbits(diff[first]).tobytes(), int(rows[first]), int(rows[same[-1]])


class Batch:
    """Left rows of one key, with the buckets of each index looked up for all of them at once."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.found = codes, {}

    def bucket(self, mask: bytes, index: Index, row: int) -> int:
        got = self.found.get(mask)
        if got is None or got[0] is not index:
            got = self.found[mask] = (index, index.buckets(self.codes))
        return got[1][row]


def taken(seq: Sequence, batch: Batch, row: int, levels: list[tuple[int, list[bytes]]]) -> tuple[bytes, int, int]:
    """(mask, matched row, consumed row) for one left row; at least one baseline row is still there."""
    while levels:
        best, some = None, []
        for m in levels[-1][1]:
            index = seq.index(m)
            bucket = batch.bucket(m, index, row)
            ends = seq.ends(index, bucket) if bucket >= 0 else None
            if ends:
                some.append(m)
                if best is None or ends[0] < best[1]:
                    best = (m, *ends)
        if best:
            levels[-1] = (levels[-1][0], some)
            return best
        levels.pop()  # rows never come back
    return seq.scan(batch.codes[row])


class Buckets:
    """Rows of one key that are still there by their values in some columns: buckets of row numbers, ascending."""

    def __init__(self, rows: np.ndarray, at: np.ndarray):
        order = np.argsort(at, kind="stable")
        self.keys, start = np.unique(at[order], return_index=True)
        end = np.append(start[1:], len(at)) - 1
        # memory views give and take plain numbers, several times faster than arrays do one at a time
        self.order, self.low, self.high = (memoryview(np.ascontiguousarray(x, np.int32)) for x in (rows[order], start, end))
        self.bytes = 4 * len(rows) + 16 * len(self.keys)

    def of(self, at: np.ndarray) -> memoryview:
        """The bucket of each left row, -1 where there is none."""
        found = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return memoryview(np.where(self.keys[found] == at, found, -1).astype(np.int32))


class Lookup:
    """Left rows of one key: their cells as the baseline's value numbers (-1: no such value), and the buckets of each
    index looked up for all of them at once."""

    def __init__(self, values: list[np.ndarray], codes: np.ndarray):
        self.codes = np.empty(codes.shape, np.int32)
        for j, known in enumerate(values):
            at = np.minimum(np.searchsorted(known, codes[:, j]), len(known) - 1)
            self.codes[:, j] = np.where(known[at] == codes[:, j], at, -1)
        self.rows, self.found = self.codes.tolist(), {}


class Standing:
    """Baseline rows of one key, which of them are still there, and how many of these have each value of a column."""

    def __init__(self, ids: list[int], codes: np.ndarray, any_null: list[bool], raw: list[int], index_bytes: int):
        self.ids, self.any_null, self.raw, self.room = ids, any_null, raw, index_bytes
        n, self.columns = codes.shape
        self.values, self.own = [], np.empty((self.columns, n), np.int32)
        for j in range(self.columns):
            known, self.own[j] = np.unique(codes[:, j], return_inverse=True)
            self.values.append(known)
        self.cells = [memoryview(x) for x in self.own]
        self.counts = [memoryview(np.bincount(x).astype(np.int32)) for x in self.own]
        self.bits = [1 << j for j in range(self.columns)]
        self.varied = sum(b for b, v in zip(self.bits, self.values) if len(v) > 1)  # others need no index
        self.there, self.left = bytearray(b"\x01") * n, n
        self.indexes, self.used, self.cleared = {}, 0, 0
        self.tries, self.differs = {}, {}
        self.rows, self.packed, self.scans = np.arange(n), self.own, 0

    def lookup(self, codes: np.ndarray) -> Lookup:
        return Lookup(self.values, codes)

    def place(self, codes: np.ndarray, agree: int) -> np.ndarray:
        """A number for each row's values in the columns ``agree`` (codes: a row a column): their place in the order of
        all combinations, or a hash where these are too many to be numbered."""
        which = [j for j in range(self.columns) if agree >> j & 1]
        if prod(len(self.values[j]) for j in which) < 1 << 62:
            out = np.zeros(codes.shape[1], np.int64)
            for j in which:
                out = out * len(self.values[j]) + codes[j]
            return out
        mixed = np.full(codes.shape[1], 17, np.uint64)
        for j in which:
            mixed = (mixed ^ codes[j].astype(np.uint64)) * _MIX
            mixed ^= mixed >> np.uint64(29)
        return mixed.view(np.int64)

    def buckets(self, batch: Lookup, agree: int) -> tuple[Buckets, memoryview] | None:
        """The index over the columns ``agree`` and the left rows' buckets; None if there is no room for it."""
        index = self.indexes.get(agree)
        if index is None:
            if self.cleared > CLEARED:
                return None
            rows = np.flatnonzero(np.frombuffer(self.there, np.uint8))
            index = Buckets(rows, self.place(self.own[:, rows], agree))
            if self.indexes and self.used + index.bytes > self.room:
                self.indexes.clear()
                batch.found.clear()
                self.used, self.cleared = 0, self.cleared + 1
            self.indexes[agree] = index
            self.used += index.bytes
        got = batch.found[agree] = (index, index.of(self.place(batch.codes.T, agree)))
        return got

    def levels(self, free: tuple[int, ...]) -> list[list[int]]:
        """The sets of columns that may agree besides those that do in any case, largest first."""
        got = self.tries.get(free)
        if got is None:
            got = self.tries[free] = [[sum(x) for x in combinations(free, n)] for n in range(len(free), -1, -1)]
        return got

    def best(self, batch: Lookup, row: int) -> tuple[list[int], int, int]:
        """(differing columns, matched row, row to consume) for one left row; at least one row is still there."""
        sure, free, left, there = 0, [], self.left, self.there
        for bit, code, count in zip(self.bits, batch.rows[row], self.counts):
            n = count[code] if code >= 0 else 0
            if n == left:
                sure |= bit
            elif n:
                free.append(bit)
        for level in self.levels(tuple(free)):
            if len(level) > 50 + left // 40:
                break
            first = last = agreed = -1
            for some in level:
                agree = sure | some
                got = batch.found.get(agree & self.varied) or self.buckets(batch, agree & self.varied)
                if got is None:
                    return self.scan(batch.codes[row])
                index, of = got
                b = of[row]
                if b < 0:
                    continue
                low, high, order = index.low[b], index.high[b], index.order
                if low > high:
                    continue
                while low <= high and not there[order[low]]:
                    low += 1
                while low <= high and not there[order[high]]:
                    high -= 1
                index.low[b], index.high[b] = low, high
                if low <= high and (first < 0 or order[low] < first):
                    first, last, agreed = order[low], order[high], agree
            if first >= 0:
                out = self.differs.get(agreed)
                if out is None:
                    out = self.differs[agreed] = [j for j, bit in enumerate(self.bits) if not agreed & bit]
                return out, first, last
        return self.scan(batch.codes[row])

    def scan(self, codes: np.ndarray) -> tuple[list[int], int, int]:
        """The same by comparing with every row that is still there."""
        self.scans += 1
        if 2 * self.left < len(self.rows):
            self.rows = np.flatnonzero(np.frombuffer(self.there, np.uint8))
            self.packed = self.own[:, self.rows]
        diff = self.packed != codes[:, None]
        gone = np.frombuffer(self.there, np.uint8)[self.rows] == 0
        n = diff.sum(0)
        n[gone] = self.columns + 1
        at = int(n.argmin())
        same = np.flatnonzero((diff == diff[:, at: at + 1]).all(0) & ~gone)
        return np.flatnonzero(diff[:, at]).tolist(), int(self.rows[at]), int(self.rows[same[-1]])

    def consume(self, row: int) -> None:
        self.there[row] = 0
        self.left -= 1
        for cell, count in zip(self.cells, self.counts):
            count[cell[row]] -= 1


def resolve(left: DataFrame, right: DataFrame, columns: int, consume_exact: bool, index_bytes: int = INDEX_BYTES
            ) -> DataFrame:
    """(_k, _lid, _mid, _cid, _d) of every left row. Both sides: (_k, _id, _o, _h, _xn, _xh); ``left`` may have the
    columns of ``short_lists``: then only listed masks are tried."""
    listed = "_masks" in left.columns
    cols = ["_k", "_side", "_id", "_h", "_xn", "_xh"] + ["_masks"] * listed
    right = right.withColumn("_masks", F.lit(None).cast("binary")) if listed else right
    both = (right.withColumn("_side", F.lit(0)).select(*cols, "_o")
            .unionByName(left.withColumn("_side", F.lit(1)).select(*cols, "_o")))
    # a number of partitions that adaptive execution keeps: the work of a key is not its bytes
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streamed = (both.withColumn("_p", F.xxhash64("_k")).repartition(n, "_p")
                .sortWithinPartitions("_k", "_side", "_o").select(*cols))
    width = mask_bytes(columns)
    make = Sequence if listed else Standing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, seq, rows = None, None, []
        for b in batches:
            ks, sides, ids, nulls, raws = (b.column(i).to_pylist() for i in (0, 1, 2, 4, 5))
            codes = _codes(b.column(3), columns)
            hs, masks = (b.column(i).to_pylist() for i in (3, 6)) if listed else (None, None)
            at = 0
            while at < len(ks):
                if ks[at] != key:
                    key, seq, rows = ks[at], None, []
                to = at
                while to < len(ks) and ks[to] == key and sides[to] == sides[at]:
                    to += 1
                if sides[at] == 0:
                    rows.append((ids[at:to], codes[at:to], nulls[at:to], raws[at:to]))
                    at = to
                    continue
                if seq is None:
                    i, h, nul, x = zip(*rows)
                    seq, rows = make(*([v for part in p for v in part] if p is not h else np.concatenate(h)
                                       for p in (i, h, nul, x)), index_bytes), []
                batch = Batch(codes[at:to]) if listed else seq.lookup(codes[at:to])
                out = []
                for j in range(at, to):
                    if not seq.left:
                        out.append((None, None, None))
                        continue
                    if listed:
                        m, first, last = taken(seq, batch, j - at, seq.levels(hs[j], masks[j], width))
                        diff = np.flatnonzero(flags(m, columns)).tolist() if any(m) else []
                    else:
                        diff, first, last = seq.best(batch, j - at)
                    keep = (not consume_exact and seq.left == 1 and not diff and not seq.any_null[last]
                            and seq.raw[last] == raws[j])
                    if not keep:
                        seq.consume(last)
                    out.append((seq.ids[first], None if keep else seq.ids[last], diff))
                mid, cid, d = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ks[at:to], pa.string()), pa.array(ids[at:to], pa.int64()), pa.array(mid, pa.int64()),
                     pa.array(cid, pa.int64()), pa.array(d, pa.list_(pa.int32()))],
                    names=["_k", "_lid", "_mid", "_cid", "_d"])
                at = to

    return streamed.mapInArrow(run, "_k string, _lid long, _mid long, _cid long, _d array<int>")


def matched(left: DataFrame, right: DataFrame, columns: int, consume_exact: bool) -> DataFrame:
    """(_k, _lid, _mid, _cid, _d) of every left row of the keys. Both sides: (_k, _id, _o, _h, _xn, _xh)."""
    if columns <= LATTICE:
        return resolve(left, right, columns, consume_exact)
    lists = short_lists(left, right, columns)
    own = left.join(lists.withColumnsRenamed({"_k": "_k2", "_h": "_h2"}),
                    (F.col("_k") == F.col("_k2")) & (F.col("_h") == F.col("_h2"))).drop("_k2", "_h2")
    return resolve(own, right, columns, consume_exact)

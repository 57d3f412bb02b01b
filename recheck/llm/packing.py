"""Best-fit packing of token pieces into sequences by the linear grouping scheme.

1. Documents become pieces: the ids of the whole text and the id of the document end, cut into ``CAPACITY`` ids from the
   end if there are more; the first piece takes what is over.
2. Lengths are whole numbers up to the capacity, so a histogram says all that packing needs to know: ``CAPACITY`` rows at
   most, however many pieces there are. On it, the driver sorts large lengths (above a quarter of the capacity) into
   groups of equal cardinality and rounds each up to its group's largest (a group whose pieces have one length rounds
   nothing: so all with ``GROUPS`` at this capacity); finds how often to use which combination of these sizes (a linear
   program over all combinations, by column generation); rounds the numbers to whole ones; and puts
   the actual lengths of the groups back in. Pieces that the rounding leaves over are grouped and combined again, until
   none is left or the program gives no whole combination. Then the rest, small lengths nearly all, is best-fitted,
   largest first, into the room that the actual lengths leave.
3. The plan is a list of runs of sequences with the same lengths inside, a few thousand whatever the input. Pieces are
   numbered within their length, and a piece's number finds its run, sequence and offset in the broadcast plan.

Cases: NULL and empty texts are one piece of one id; NULL and repeated doc_ids are kept; an empty table gives an empty
result; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, numbered, quoted
from recheck.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
# Groups of equal cardinality, where there are more large lengths than that; else each length is a size of its own.
GROUPS = 1536
# A combination that leaves room, but less than this part of the capacity, costs so much of a sequence more: rooms that
# small pieces can fill come in few sequences instead of a little in most.
GAP, LOSS = 1 / 8, 0.02
# The program ends when no combination would save more than this part of a sequence.
ENOUGH = 1e-3
# Texts tokenized at a time.
BATCH = 256

# A run: [number of sequences, [(length, how many of it), ...]]
Run = tuple[int, tuple[tuple[int, int], ...]]


def grouped(hist: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """(rounded length, [[length, count], ...] descending) of groups of equal cardinality, largest lengths first."""
    total = sum(hist.values())
    out: list[tuple[int, list[list[int]]]] = []
    share, room = -(-total // max(1, groups)), 0
    for length in sorted(hist, reverse=True):
        n = hist[length]
        while n:
            if not room:
                out.append((length, []))
                room = share
            take = min(n, room)
            out[-1][1].append([length, take])
            n, room = n - take, room - take
    merged: list[tuple[int, list[list[int]]]] = []
    for size, members in out:  # groups with one rounded length are one size
        if merged and merged[-1][0] == size:
            merged[-1][1].extend(members)
        else:
            merged.append((size, members))
    return merged


def twos(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of the sizes (descending) beside which a third fits, and the room for it."""
    least = int(sizes.min())
    first = len(sizes) - int((sizes <= capacity - 2 * least).sum())
    a, b = np.triu_indices(len(sizes) - first)
    rest = capacity - sizes[a + first] - sizes[b + first]
    return (a + first)[rest >= least], (b + first)[rest >= least], rest[rest >= least]


def dearest(sizes: np.ndarray, worth: np.ndarray, capacity: int, loss: float = LOSS,
            pairs: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None) -> tuple[float, np.ndarray]:
    """Best combination of the sizes within the capacity: (worth less what its gap costs, how many of each). Sizes are
    above a quarter of the capacity, so a combination has one to three pieces."""
    gap = max(1, int(capacity * GAP))
    value = np.full(capacity + 1, -np.inf)
    value[0] = 0.0  # no piece
    value[sizes] = worth
    top = np.maximum.accumulate(value)  # of at most one piece, by the room for it
    place = np.maximum.accumulate(np.where(value >= top, np.arange(capacity + 1), 0))
    # the same, less what the room that stays costs: none, a gap, or room for small pieces
    stays = [value, np.r_[-np.inf, top[:-1] - loss], np.r_[np.full(gap, -np.inf), top[:-gap]]]
    which = np.argmax(stays, axis=0)
    last_worth = np.max(stays, axis=0)
    last_piece = np.choose(which, [np.arange(capacity + 1), np.r_[0, place[:-1]], np.r_[np.zeros(gap, int), place[:-gap]]])
    index = np.full(capacity + 1, -1)
    index[sizes] = np.arange(len(sizes))
    room = capacity - sizes
    i = int(np.argmax(worth + last_worth[room]))
    best, chosen, last = worth[i] + last_worth[room[i]], [i], room[i]
    a, b, rest = twos(sizes, capacity) if pairs is None else pairs
    if len(a):
        three = worth[a] + worth[b] + last_worth[rest]
        j = int(np.argmax(three))
        if three[j] > best + 1e-12:
            best, chosen, last = three[j], [a[j], b[j]], capacity - sizes[a[j]] - sizes[b[j]]
    used = np.zeros(len(sizes))
    np.add.at(used, [*chosen, *([index[last_piece[last]]] if last_piece[last] else [])], 1)
    return float(best), used


def cost(room: np.ndarray, capacity: int, loss: float = LOSS) -> np.ndarray:
    """What a sequence with that room left costs."""
    return 1.0 + loss * ((room > 0) & (room < max(1, int(capacity * GAP))))


def combinations(sizes: list[int], need: list[int], capacity: int, rounds: int = 20_000) -> list[tuple[float, np.ndarray]]:
    """(times, how many of each size): the linear program's answer, over all combinations that fit."""
    sizes_, need_ = np.array(sizes), np.array(need, float)
    base = np.diag([float(capacity // s) for s in sizes])
    costs, pairs = cost(capacity - sizes_ @ base, capacity), twos(sizes_, capacity)
    inverse, x = np.diag(1 / np.diag(base)), need_ / np.diag(base)
    prices = costs @ inverse  # what a size is worth in sequences
    for turn in range(1, rounds):
        worth, new = dearest(sizes_, np.maximum(prices, 0), capacity, pairs=pairs)
        if worth <= 1 + ENOUGH:
            break
        parts = np.flatnonzero(new)
        way = inverse[:, parts] @ new[parts]
        ratio = np.where(way > 1e-9, np.maximum(x, 0) / np.where(way > 1e-9, way, 1), np.inf)
        out = int(np.argmin(ratio))
        base[:, out], costs[out] = new, cost(capacity - sizes_ @ new, capacity)
        if turn % 1000 == 0:
            inverse = np.linalg.inv(base)  # keeps rounding errors small
            x, prices = inverse @ need_, costs @ inverse
        else:
            step, row = ratio[out], inverse[out] / way[out]
            prices = prices + (costs[out] - prices[parts] @ new[parts]) * row
            moved = np.flatnonzero(np.abs(way) > 1e-12)
            inverse[moved] -= way[moved, None] * row
            inverse[out] = row
            x = x - step * way
            x[out] = step
    return list(zip(np.linalg.solve(base, need_), base.T))


def whole(used: list[tuple[float, np.ndarray]], need: list[int]) -> list[int]:
    """Whole numbers of the combinations, rounded to the nearest as far as pieces are there, else down; if all are 0, the
    most used one is taken once."""
    times = [int(x + 1e-6) for x, _ in used]
    left = np.array(need, float) - sum((t * c for t, (_, c) in zip(times, used)), np.zeros(len(need)))
    part = [x - t for t, (x, _) in zip(times, used)]
    for j in sorted(range(len(used)), key=lambda j: -part[j]):
        if part[j] >= 0.5 - 1e-9 and (left >= used[j][1] - 1e-9).all():
            times[j] += 1
            left = left - used[j][1]
    if not any(times):
        j = max(range(len(used)), key=lambda j: used[j][0])
        times[j] = int((np.array(need) >= used[j][1]).all())
    return times


class Open:
    """Runs by the room left in their sequences."""

    def __init__(self, capacity: int):
        self.capacity, self.rooms, self.runs = capacity, [], {}

    def put(self, n: int, inside: tuple[tuple[int, int], ...]) -> None:
        if n:
            room = self.capacity - sum(a * b for a, b in inside)
            if room not in self.runs:
                insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((n, inside))

    def fit(self, length: int, count: int) -> None:
        """Places ``count`` pieces where the least room is left that takes them; new sequences when there is none."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                self.put(count // each, ((length, each),))
                if count % each:
                    self.put(1, ((length, count % each),))
                return
            room = self.rooms[at]
            n, inside = self.runs[room].pop()
            if not self.runs[room]:
                del self.runs[room]
                self.rooms.pop(at)
            each = room // length
            full = min(n, count // each)
            self.put(full, (*inside, (length, each)))
            n, count = n - full, count - full * each
            if n and 0 < count < each:
                self.put(1, (*inside, (length, count)))
                n, count = n - 1, 0
            self.put(n, inside)


def plan(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[Run]:
    """Runs that hold exactly the pieces of the histogram."""
    left = {length: n for length, n in hist.items() if n > 0}
    runs = Open(capacity)
    runs.put(left.pop(capacity, 0), ((capacity, 1),))
    while configured(left, runs, capacity, groups):
        pass
    for length in sorted(left, reverse=True):
        if left[length]:
            runs.fit(length, left[length])
    return [r for room in runs.rooms for r in runs.runs[room]]


def configured(left: dict[int, int], runs: Open, capacity: int, groups: int) -> int:
    """Takes pieces out of ``left`` into combinations, with their actual lengths, as one program says; how many."""
    pieces = {k: n for k, n in left.items() if n and k > capacity // 4}
    if not pieces:
        return 0
    own = [(k, [[k, pieces[k]]]) for k in sorted(pieces, reverse=True)]
    large = own if len(own) <= groups else grouped(pieces, groups)
    need, taken = [sum(n for _, n in m) for _, m in large], 0
    used = combinations([s for s, _ in large], need, capacity)
    members = [[list(x) for x in m] for _, m in large]
    for n, (_, combination) in zip(whole(used, need), used):
        if not n:
            continue
        # the actual lengths of each slot, in stretches; a run ends where a stretch of any slot does
        slots = [stretches(members[i], n) for i in np.flatnonzero(combination) for _ in range(int(combination[i]))]
        done = 0
        for e in sorted({e for slot in slots for e, _ in slot}):
            inside = tuple((next(v for end, v in slot if end >= e), 1) for slot in slots if slot and slot[-1][0] >= e)
            for v, _ in inside:
                left[v] -= e - done
                taken += e - done
            runs.put(e - done, inside)
            done = e
    return taken


def stretches(members: list[list[int]], n: int) -> list[tuple[int, int]]:
    """Takes ``n`` pieces off a group, largest first: [(number of sequences up to here, length), ...]."""
    out, done = [], 0
    for m in members:
        take = min(m[1], n - done)
        if take:
            m[1] -= take
            done += take
            out.append((done, m[0]))
    return out


def slots(runs: list[Run]) -> np.ndarray:
    """The plan by length: rows (length, first number, sequence, pieces a sequence, offset), sorted."""
    rows, sequence, given = [], 0, {}
    for n, inside in runs:
        offset = 0
        for length, each in inside:
            rows.append((length, given.get(length, 0), sequence, each, offset))
            given[length] = given.get(length, 0) + n * each
            offset += length * each
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False, special: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, and with ``ids`` the ids (little-endian, 4 bytes).
    ``special``: see ``tokens``."""
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).cast("string").alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, "<u4", special).ids
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                row, piece, start, length, crc, held = [], [], [], [], [], []
                for k, got in enumerate(encode([t or "" for t in b.column(1).to_pylist()])):
                    got += end
                    n = len(got) // 4
                    first = (n - 1) % capacity + 1
                    for p, s in enumerate([0, *range(first, n, capacity)]):
                        part = got[4 * s: 4 * (first if p == 0 else s + capacity)]
                        row.append(k)
                        piece.append(p)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        held.append(part)
                cols = [b.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(held, pa.binary())] * ids, names + ["ids"] * ids)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
                           + ", ids binary" * ids)


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with a column length; checkpointed) with sequence_id and offset."""
    hist = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}  # at most ``capacity`` rows
    shared = parts.sparkSession.sparkContext.broadcast(slots(plan(hist, capacity)))
    rows = numbered(parts, ["length"], "_number")
    at = rows.columns.index("_number"), rows.columns.index("length")
    names = [c for c in rows.columns if c != "_number"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        wide = int(table[:, 1].max()) + 1 if len(table) else 1
        keys = table[:, 0] * wide + table[:, 1]
        for b in batches:
            number, length = (b.column(i).to_numpy() for i in at)
            row = table[np.searchsorted(keys, length * wide + np.minimum(number, wide - 1), "right") - 1]
            inside = number - row[:, 1]
            cols = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(row[:, 2] + inside // row[:, 3]), pa.array(row[:, 4] + inside % row[:, 3] * length)],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_number")
    return rows.mapInArrow(find, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = False, special: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (with ``ids``: the ids too).
    ``special``: the string of a special token is that token, the tokenizer library's default."""
    return place(checkpointed(pieces(docs, doc_id, text, tokenizer, capacity, end_id, ids, special)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, lengths) of packed pieces with ids: what training reads. A group holds one sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: x["length"]).alias("lengths"))

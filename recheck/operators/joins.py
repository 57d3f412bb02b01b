"""Join helpers: broadcasts of checked size for lookup-sized sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Value sets are broadcast as long as the bytes of all sets of one plan stay below this bound together; the rest stay
# shuffle joins, which AQE may still convert from measured sizes.
BROADCAST_MAX_BYTES = 64 << 20
# What a row of a hashed relation takes besides its values.
ROW_BYTES = 48


def set_bytes(*sets: DataFrame) -> list[int]:
    """Bytes that each table takes when broadcast (its values as text, and a row's overhead); one job for all."""
    if not sets:
        return []
    parts = []
    for i, d in enumerate(sets):
        row = F.lit(ROW_BYTES)
        for c in d.columns:
            row = row + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8
        parts.append(d.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0)).alias("n")).select(F.lit(i).alias("i"), "n"))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    got = {r.i: r.n for r in u.collect()}
    return [got[i] for i in range(len(sets))]


def sized(sets: Sequence[DataFrame], max_bytes: int = BROADCAST_MAX_BYTES) -> list[tuple[DataFrame, bool]]:
    """The sets, smallest first marked for broadcast until ``max_bytes`` are reached in sum, and whether each is."""
    out, room = [(s, False) for s in sets], max_bytes
    for n, i in sorted((n, i) for i, n in enumerate(set_bytes(*sets))):
        if n > room:
            break
        room -= n
        out[i] = F.broadcast(sets[i]), True
    return out


def hinted(sets: Sequence[DataFrame], max_bytes: int = BROADCAST_MAX_BYTES) -> list[DataFrame]:
    """The sets, smallest first marked for broadcast until ``max_bytes`` are reached in sum."""
    return [s for s, _ in sized(sets, max_bytes)]


def member_set(values: DataFrame, name: str) -> DataFrame:
    """The distinct values of a one-column table, with a marker column ``name``."""
    return values.toDF(f"{name}_v").distinct().withColumn(name, F.lit(True))


def member_flag(df: DataFrame, col, members: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: is ``col`` in ``members`` (a ``member_set``; NULL-safe: NULL is a member only if the set
    holds NULL, as pandas ``isin``)."""
    c = F.col(col) if isinstance(col, str) else col
    out = df.join(members, c.eqNullSafe(F.col(f"{name}_v")), "left").drop(f"{name}_v")
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(False)))

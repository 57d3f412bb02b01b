"""What the operators of this package share: words, row keys, gapless numbers, applied decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recheck.session import materialize

# A word is a run of characters other than ASCII white space; the same set as Python's ``bytes.split()``.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only (``lower`` would change other letters too)."""
    return F.translate(text, UPPER, LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the folder named by spark.checkpoint.dir; its rows and partitions stay as they are now."""
    return materialize(df)


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def row_key(df: DataFrame) -> Column:
    """64-bit hash over the columns of a row (maps, which cannot be hashed, are left out). Only used together with
    doc_id, to find a row again in a second scan of its table."""
    return F.xxhash64(*[F.col(quoted(f.name)) for f in df.schema.fields if not has_map(f.dataType)])


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``name``: gapless numbers from 0 within each value of ``keys``, in the order of ``df``'s partitions.

    ``df`` must be checkpointed, so that each scan sees the same partitions. Rows are counted by partition and key,
    the counts are summed up over the partitions, and rows are numbered inside (partition, key): no task holds more of
    a key than one partition of the input has. NULL is a key value like any other.
    """
    pid, rid, base, n = (fresh(df, x) for x in ("_pid", "_rid", "_base", "_n"))
    rows = df.withColumn(pid, F.spark_partition_id()).withColumn(rid, F.monotonically_increasing_id())
    counts = rows.groupBy(*keys, pid).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*keys).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    # positional names: joins on null-safe equality need distinct column names on both sides
    starts = counts.select(*[F.col(quoted(k)).alias(f"{base}{i}") for i, k in enumerate(keys)],
                           F.col(pid).alias(f"{base}p"), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base))
    on = F.col(pid) == F.col(f"{base}p")
    for i, k in enumerate(keys):
        on = on & F.col(quoted(k)).eqNullSafe(F.col(f"{base}{i}"))
    within = Window.partitionBy(*keys, pid).orderBy(rid)
    return (rows.withColumn(n, F.row_number().over(within)).join(starts, on)
            .withColumn(name, F.col(base) + F.col(n) - 1)
            .drop(pid, rid, base, n, f"{base}p", *[f"{base}{i}" for i in range(len(keys))]))


def take_copies(docs: DataFrame, doc_id: str, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as decided: ``decisions`` (id, key, copies, n) says how many rows shall come
    of the ``n`` rows with one doc_id and one ``row_key``. Such rows are equal, so any of them serve."""
    key, at, times = (fresh(docs, x) for x in ("_key", "_at", "_times"))
    taken = decisions.where("copies > 0").select(F.col("id").alias(f"{key}_id"), F.col("key").alias(f"{key}_2"),
                                                 F.col("copies").alias(f"{key}_c"), F.col("n").alias(f"{key}_n"))
    own = docs.withColumn(key, row_key(docs))
    id_col = F.col(quoted(doc_id))
    found = own.join(taken, (F.col(key) == F.col(f"{key}_2")) & id_col.eqNullSafe(F.col(f"{key}_id")))
    among = Window.partitionBy(key, quoted(doc_id)).orderBy(key)
    c, n = F.col(f"{key}_c"), F.col(f"{key}_n")
    share = F.floor(c / n) + F.when(F.col(at) <= c % n, 1).otherwise(0)
    out = found.withColumn(at, F.row_number().over(among)).withColumn(times, share.cast("int")).where(F.col(times) > 0)
    # most rows come once: they need no generator
    return out.withColumn(at, F.explode(F.sequence(F.lit(1), F.col(times)))).select(
        *[F.col(quoted(c)) for c in docs.columns])

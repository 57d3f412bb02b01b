"""Mixing sources to target weights by systematic sampling, in DataFrame expressions only.

The size of a document is its number of words. Sources in code point order (NULL last) weigh 1, 2, 3, 1, 2, 3, ...;
together they get as many words as all documents have. No source gets more than ``MOST`` times its own words: what is
above is shared among the others by weight until none is above. With r = target / own words, each document of a source
expects r copies. Documents stand in order of size, the largest first; their expected copies are summed up from the
front, one random offset a source is added, and a document comes once for each integer that its stretch of the sum
crosses: rounded down or up from what it expects, so at most MOST times. Neighbours in the order have nearly the same
size, so only the few largest documents move the words taken away from the target. When the sum reaches the small
documents, which hold ``SMALL_SHARE`` of the source's words, what was taken is known: from there on each expects as many
copies as make up for it (0 to MOST), and the same sum goes on. The words that a source gives come within about one small
document of its target.

The offset is a hash of seed and source: reruns agree, whatever the partitions. Where the small documents begin, the sum's
part behind the point is put on the offset's grid (2^-17), so that whole expectations are drawn exactly. Prefix sums go
by partition (counts first, then numbers inside a partition), so a source with any part of the rows is dealt over many
tasks.

Cases: a NULL text or one without words has size 0 and is drawn like others; a source of words 0 has target 0 and gives
nothing; NULL sources are one source, the last; rows equal in source, size and doc_id may swap; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recheck.llm.common import WORD, checkpointed, numbered, quoted, row_key, take_copies

WEIGHTS = (1, 2, 3)
MOST = 3
# The small documents: the lowest powers of two of the size that hold this share of a source's words together.
SMALL_SHARE = 0.25
SEED = "mix-1"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str = SEED) -> Column:
    """In (0, 1), on a grid of 2^-17: sums with it stay exact as long as r is 3 or another whole number."""
    name = F.concat(F.lit(seed), F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)))
    return (F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("double") + 0.5) / 65536.0


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(src, source_size, target) of every source in ``sizes`` (src, size).

    In order of most * size / weight, a source is at its limit if its share of what is left, together with all sources
    after it, reaches the limit. The share of a unit of weight is largest at the first source that isn't.
    """
    own = sizes.groupBy("src").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    w = Window.orderBy("limit_by_weight", "k")
    return (own.withColumn("k", place).withColumn("weight", weight)
            .withColumn("top", (most * F.col("source_size")).cast("double"))
            .withColumn("limit_by_weight", F.col("top") / F.col("weight"))
            .withColumn("spent", F.coalesce(F.sum("top").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("open", F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing)))
            .withColumn("words", F.sum("source_size").over(Window.partitionBy()).cast("double"))
            .withColumn("unit", F.max((F.col("words") - F.col("spent")) / F.col("open")).over(Window.partitionBy()))
            .select("src", "source_size", F.least("top", F.col("unit") * F.col("weight")).alias("target")))


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         key: bool = False) -> DataFrame:
    """One row per document: doc_id, src, size, source_size, target, copies; with ``key`` its row key too."""
    cols = [F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(source)).cast("string").alias("src"),
            words_of(F.col(quoted(text))).alias("size")]
    base = checkpointed(docs.select(*cols, *([row_key(docs).alias("key")] if key else [])))
    by = [F.col("src").asc_nulls_last(), F.col("size").desc(), F.col("doc_id").asc_nulls_last(), F.col("rid").asc()]
    rows = checkpointed(base.withColumn("rid", F.monotonically_increasing_id()).repartitionByRange(*by)
                        .sortWithinPartitions(*by).drop("rid"))
    goal = targets(base).withColumnRenamed("src", "src_2")
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("at").cast("double")

    def drawn(place: Column, rate: Column, begin: Column) -> Column:
        """Integers that the ``place``-th stretch of a sum crosses, which goes on from ``begin``."""
        return F.floor((place + 1.0) * rate + begin) - F.floor(place * rate + begin)

    first = checkpointed(numbered(rows, ["src"], "at").join(goal, F.col("src").eqNullSafe(F.col("src_2"))).drop("src_2")
                         .withColumn("r", r).withColumn("copies", drawn(at, F.col("r"), offset(F.col("src"))))
                         .withColumn("power", F.length(F.bin("size"))))
    fixed = small_rates(first).withColumnsRenamed({"src": "src_2"})
    return (first.join(fixed, F.col("src").eqNullSafe(F.col("src_2"))).drop("src_2")
            .withColumn("copies", F.when(F.col("power") <= F.col("small"), drawn(
                at - F.col("before"), F.col("rate"), F.col("begin"))).otherwise(F.col("copies")))
            .drop("at", "r", "power", "small", "rate", "before", "begin"))


def small_rates(first: DataFrame) -> DataFrame:
    """(src, small, rate, before, begin): sizes of up to ``small`` binary digits are the source's small documents;
    ``rate`` is the number of copies that each of them expects after what was taken of the ``before`` larger ones, and
    ``begin`` the part behind the point that the sum has reached there."""
    by_power = first.groupBy("src", "power").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * F.col("copies")).alias("taken"), F.max("r").alias("r"),
        F.count(F.lit(1)).alias("docs"), F.max("target").alias("target"), F.max("source_size").alias("source_size"))
    up = Window.partitionBy("src").orderBy("power").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("src").orderBy("power").rowsBetween(1, Window.unboundedFollowing)
    cut = (by_power.withColumn("low", F.sum("words").over(up))
           .withColumn("high", F.coalesce(F.sum("taken").over(above), F.lit(0)))
           .withColumn("before", F.coalesce(F.sum("docs").over(above), F.lit(0)).cast("double"))
           .where(F.col("low") >= F.col("source_size") * SMALL_SHARE))
    rate = F.least(F.lit(float(MOST)), F.greatest(F.lit(0.0), (F.col("target") - F.col("high")) / F.col("low")))
    reached = F.col("before") * F.col("r") + offset(F.col("src"))
    begin = (F.floor((reached - F.floor(reached)) * 65536.0) + 0.5) / 65536.0
    names = ["power", "target", "high", "low", "before", "r"]
    return cut.groupBy("src").agg(F.min_by(F.struct(*names), "power").alias("c")).select("src", "c.*").select(
        "src", F.col("power").alias("small"), F.when(F.col("low") > 0, rate).otherwise(F.lit(0.0)).alias("rate"), "before",
        begin.alias("begin"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed documents, with all their columns: a row for each copy."""
    rows = plan(docs, doc_id, text, source, key=True)
    return take_copies(docs, doc_id, rows.groupBy(F.col("doc_id").alias("id"), "key").agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")))

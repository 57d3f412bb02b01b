"""Scans and sinks.

Flat files, lookups, JDBC tables/queries and object-store prefixes become DataFrames; result tables are written one
dataset per name. Paths are any Hadoop file-system URI (``file://``, ``hdfs://``, ``s3a://`` ...); credentials come
from the cluster configuration, never from code.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from recheck.functions.cells import nan_to_null
from recheck.operators.joins import hinted
from recheck.operators.order import with_rank
from recheck.session import Scratch

# File extension -> Spark source.
FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".orc": "orc", ".txt": "csv"}


def _fmt_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext not in FORMATS:
        raise ValueError(f"cannot tell the format of {path!r}; pass fmt= (csv, parquet, json, orc)")
    return FORMATS[ext]


def read_table(spark: SparkSession, path: str, schema=None, fmt: str | None = None, **options) -> DataFrame:
    """Flat-file scan, format from the extension unless ``fmt`` is given (S1). CSV has a header; NaN -> NULL.

    Pass ``schema`` for CSV/JSON at scale: inference costs a full extra pass.
    """
    f = _fmt_of(path, fmt)
    r = spark.read.format(f)
    if f == "csv":
        r = r.option("header", True).option("multiLine", options.pop("multiLine", False))
        if schema is None:
            r = r.option("inferSchema", True)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    return nan_to_null(r.load(path))


def read_checked(spark: SparkSession, path: str, schema: str, header: bool = True, **options
                 ) -> tuple[DataFrame, DataFrame]:
    """A CSV scan that loses nothing: (rows, rejects). ``rejects``: file, line, record of every line that does not fit
    ``schema`` (a cell of another type, too many or too few cells); ``rows`` are all other lines, NaN -> NULL (S1, S2).

    Lines are read as text and parsed as expressions, so a file is split as any text file; a line's number is its place in
    its split plus the lines of the file's splits before. A quoted cell must not go over lines. ``header``: the first
    line of each file is its header. Empty lines are skipped.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    up = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(F.col("file").alias("f"), F.col("block").alias("b"), "first",
                           F.coalesce(F.sum("n").over(up), F.lit(0)).alias("before"))  # a row a split: small
    numbered = lines.join(splits, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b"))).select(
        "file", (F.col("before") + F.col("place") - F.col("first") + 1).alias("line"), "value")
    own = numbered.where((F.trim("value") != "") & ((F.col("line") > 1) if header else F.lit(True)))
    bad = "_bad"
    parsed = own.withColumn("row", F.from_csv("value", f"{schema}, {bad} string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, **options}))
    rejects = parsed.where(F.col(f"row.{bad}").isNotNull()).select("file", "line", F.col("value").alias("record"))
    rows = parsed.where(F.col(f"row.{bad}").isNull()).select("row.*").drop(bad)
    return nan_to_null(rows), rejects


def read_lookup(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    """Lookup CSV (quoted commas, CRLF): a small table joined by size-checked broadcast."""
    return read_table(spark, path, schema=schema, fmt=_fmt_of(path, options.pop("fmt", None)), **options)


def read_jdbc(spark: SparkSession, url: str, table: str | None = None, query: str | None = None,
              partition_col: str | None = None, lower_bound=None, upper_bound=None, num_partitions: int | None = None,
              fetch_size: int = 10000, **options) -> DataFrame:
    """Database table (S3) or query (S4) scan. Filters and projections on the result are pushed to the database.

    For big tables give ``partition_col`` with bounds and ``num_partitions`` so the read runs as parallel range
    queries instead of one connection. Connection options (user, password, driver) come from the caller.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table= or query=")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    r = r.option("dbtable", table) if table is not None else r.option("query", query)
    if partition_col is not None:
        if table is None:
            raise ValueError("partitioned reads need table= (Spark does not partition query= reads)")
        r = (r.option("partitionColumn", partition_col).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def read_prefix(spark: SparkSession, uri: str, glob: str = "*", fmt: str = "csv", schema=None,
                **options) -> DataFrame:
    """Every file under ``uri`` whose name matches ``glob``, with its ``source_file``."""
    r = spark.read.format(fmt).option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    if fmt == "csv":
        r = r.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(uri)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def write_results(results: dict[str, DataFrame], base: str, fmt: str = "parquet", mode: str = "overwrite") -> dict:
    """One dataset per result name under ``base`` (S7, S9); returns name -> path."""
    out = {}
    for name, df in results.items():
        path = f"{base.rstrip('/')}/{name}"
        w = df.write.mode(mode).format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(path)
        out[name] = path
    return out


# Rows of a value from which on it gets a further file.
ROWS_PER_FILE = 1_000_000
# Formats whose files name their columns: there a row's part stands in the file, elsewhere it is a folder.
NAMED_COLUMNS = ("parquet", "orc")


def write_partitioned(df: DataFrame, path: str, by: str = "file_name", sort: Sequence[str] = (),
                      fmt: str = "parquet", mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE) -> str:
    """One output folder per ``by`` value, rows sorted within, one file for each ``rows_per_file`` rows of a value.

    Rows are numbered inside their value in the order of ``sort`` (``order.with_rank``: no task holds a value), and the
    number says which file a row goes to: a small value has one file, a large one several that follow each other. A file
    is written by one task. ``manifest`` lists what was written.

    A value's files stand in one folder (Parquet, ORC; the column ``part`` tells them apart): with a folder for each
    file, listing the folders takes as long as writing them. A task begins a file every ``rows_per_file`` rows of a
    value, which is where the next part begins, as only a value's last part is shorter. Tasks move their files to
    their place themselves (committer version 2; the driver else moves one after the other): after a failed write, files
    may stand there, without ``_SUCCESS``.
    """
    scratch = Scratch(df.sparkSession, "by-value")
    order = [F.col(c).asc_nulls_last() for c in sort]
    number, total, part = (_free(n, df) for n in ("_number", "_total", "part"))
    if df.select(by).dtypes[0][1] == "string":  # NULL and '' have the same folder: one value
        df = df.withColumn(by, F.when(F.col(by) != "", F.col(by)))
    ranked = with_rank(df, [by], order, scratch, number, total)
    out = ranked.withColumn(part, F.floor(F.col(number) / rows_per_file).cast("int")).drop(total)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    w = (out.repartition(n, by, part).sortWithinPartitions(by, part, number).drop(number).write.mode(mode).format(fmt)
         .option("maxRecordsPerFile", rows_per_file).option("mapreduce.fileoutputcommitter.algorithm.version", 2)
         .partitionBy(*([by] if fmt in NAMED_COLUMNS else [by, part])))
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    scratch.drop()
    return path


def manifest(spark: SparkSession, path: str, by: str = "file_name", sort: Sequence[str] = (), fmt: str = "parquet",
             schema=None, publish: bool = True, more: dict[str, Column] | None = None) -> DataFrame:
    """What ``write_partitioned`` wrote: a row for each file with its value, part, rows, and its first and last row's
    ``sort`` columns (structs ``first``, ``last``). ``more``: further aggregates over a file's rows, by name. ``publish``
    writes it beside the data, as ``<path>.manifest``."""
    r = spark.read.format(fmt)
    if schema is not None and fmt in NAMED_COLUMNS:
        schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        schema = schema if "part" in schema.names else StructType([*schema, StructField("part", IntegerType())])
    r = r.schema(schema) if schema is not None else r
    df = (r.option("header", True) if fmt == "csv" else r).load(path)
    key = F.struct(*[c for s in sort for c in (F.col(s).isNull().alias(f"{s}_is_null"), F.col(s))])
    out = df.groupBy(F.col(by), "part", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *([F.min(key).alias("first"), F.max(key).alias("last")] if sort else []),
        *[c.alias(name) for name, c in (more or {}).items()])
    if publish:
        out.repartition(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}.manifest")  # a row a file
        return spark.read.parquet(f"{path.rstrip('/')}.manifest")
    return out


def in_order(sort: Sequence[str]) -> Column:
    """Aggregate over the rows of a Parquet file: whether they stand there in the order of ``sort``, NULLs last. It holds
    a file's places and ``sort`` columns, so is meant for files of bounded rows (``rows_per_file``)."""
    key = F.struct(*[c for s in sort for c in (F.col(s).isNull().alias(f"{s}_is_null"), F.col(s))])
    rows = F.collect_list(F.struct(F.col("_metadata.row_index").alias("at"), key.alias("key")))
    as_written = F.transform(F.array_sort(rows), lambda r: r["key"])
    return as_written == F.array_sort(as_written)


def _free(name: str, df: DataFrame) -> str:
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (``spark.checkpoint.dir``), never a machine-local temp; removed
    when Python ends (``session.Scratch``)."""
    return Scratch(spark, name).path


def resolve_category(taxonomy: DataFrame, name: str, name_col: str = "category_name",
                     id_col: str = "category_id") -> DataFrame:
    """The taxonomy row of category ``name`` (S5); raises if the taxonomy has no such category."""
    row = taxonomy.where(F.col(name_col) == F.lit(name)).select(name_col, id_col)
    if row.limit(1).count() == 0:
        raise ValueError(f"unknown category {name!r}")
    return row


def facts_for_category(facts: DataFrame, master: DataFrame, category: DataFrame, product_col: str = "product_id",
                       master_product_col: str = "product_id", category_col: str = "category_id") -> DataFrame:
    """Facts of the products in one category: ``category_id, facts.*``.

    The product master is filtered to the category first; that side is broadcast when its size is proven small.
    """
    cat_ids = category.select(F.col(category_col).alias("_cid")).distinct()
    m = master.join(cat_ids, F.col(category_col) == F.col("_cid"), "left_semi").select(
        F.col(master_product_col).alias("_pid"), F.col(category_col).alias("category_id"))
    j = facts.join(hinted([m])[0], F.col(product_col) == F.col("_pid"))
    return j.select("category_id", *[facts[c] for c in facts.columns])

"""Token counts of flat token files by a separator scan.

A flat file is the ids of document after document, each in a fixed number of bytes, an end-of-document id behind each
document, and no index. The scan cuts files into blocks, finds the end ids of a block with one vectorised comparison,
and stitches: a prefix scan over the blocks of a file says where the document that is open at a block's first id began
and how many documents ended before. A document may span any number of blocks.

Tasks open files by ``file:`` paths, as Spark does, and read a block at a time, so that no task holds a file whole; files
above ``FILE_BYTES`` are dealt to tasks as byte ranges of whole blocks. In other stores, whose files only Spark reads, it
reads files of up to ``FILE_BYTES`` whole, one a task, and cuts them to blocks before Python gets them; larger ones go
through its fixed-length record reader, with the longest records that fill the file (``record_ends``). ``write_flat``
makes such files from documents, one a partition, with Spark's text writer: the line separator is the end id. For such
stores it writes a file in pieces of ``PIECE_ROWS`` documents, whose blocks follow each other in one file (``joined``).

Cases: an empty file has no documents; ids behind the last end id are a document with complete = false; a NULL or empty
text is a document of 0 tokens; bytes behind the last whole id are ignored; only the text column is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recheck.llm.common import checkpointed, quoted
from recheck.llm.tokens import encoder
from recheck.session import ensure_checkpoint_dir

END_ID = 50256  # <|endoftext|> of byte_bpe_50k
DTYPE = "<u2"
BLOCK_TOKENS = 1 << 16
FILE_BYTES = 1 << 28
BATCH = 256
BATCH_ENDS = 1 << 20
PIECE_ROWS = 4096

_ENDS = "file string, block bigint, n bigint, ends array<int>"
_RANGES = "file string, first bigint, tokens bigint"


def write_flat(docs: DataFrame, path: str, text: str = "text", tokenizer: str | None = None, end_id: int = END_ID,
               dtype: str = DTYPE, piece_rows: int = 0) -> None:
    """Flat token files of the texts under ``path``, a file a partition, in pieces of ``piece_rows`` documents if given."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer, dtype).ids
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                got = ids([t or "" for t in whole.column(0).slice(at, BATCH).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], names=["ids"])

    rows = docs.select(F.col(quoted(text)).cast("string").alias("text")).mapInArrow(encode, "ids binary")
    # the writer puts the bytes of a string as they are, and the separator's bytes behind each row
    end = np.array([end_id], dtype).tobytes().decode("latin-1")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option(
        "lineSep", end).option("maxRecordsPerFile", piece_rows).text(path)


def ends_of(file: str, first_block: int, data: bytes, end_id: int, dtype: str, block_tokens: int) -> list[tuple]:
    """(file, block, tokens, places of the end ids in the block) of the blocks of ``data``."""
    ids = np.frombuffer(data, dtype, len(data) // np.dtype(dtype).itemsize)
    return [(file, first_block + k, len(b), np.flatnonzero(b == end_id).astype(np.int32))
            for k, b in enumerate(ids[at: at + block_tokens] for at in range(0, len(ids), block_tokens))]


def in_file_store(spark: SparkSession, path: str) -> bool:
    """Whether the files under ``path`` have ``file:`` paths."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def block_ends(spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE,
               block_tokens: int = BLOCK_TOKENS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """(file, block, n, ends): the end ids of every block of the files under ``path``."""
    files = spark.read.format("binaryFile").load(path)
    item = np.dtype(dtype).itemsize

    def whole(some: Column) -> DataFrame:
        return cut(files.where(some), block_tokens * item, item).mapInArrow(
            block_scan(end_id, dtype, block_tokens), _ENDS)

    large = files.where(F.col("length") > file_bytes).select("path", "length").collect()
    if in_file_store(spark, path):
        ranged = range_scan(end_id, dtype, block_tokens)
        # only names and lengths are asked for: Spark deals the files by their lengths, and reads none of them
        small = files.where(F.col("length") <= file_bytes).select(
            "path", F.lit(0).cast("bigint"), F.floor(F.col("length") / item))
        out = small.mapInArrow(ranged, _ENDS)
        each = max(1, file_bytes // (block_tokens * item)) * block_tokens  # tokens of a range
        ranges = [(r.path, at, min(each, r.length // item - at)) for r in large
                  for at in range(0, r.length // item, each)]
        if ranges:
            dealt = spark.createDataFrame(spark.sparkContext.parallelize(ranges, len(ranges)), _RANGES)
            out = out.unionByName(dealt.mapInArrow(ranged, _ENDS))
        return out
    out = whole(F.col("length") <= file_bytes)
    for r in large:
        # records must fill the file: with a part of an id at its end, the file is read by one task
        got = (whole((F.col("path") == r.path) & (F.col("length") > file_bytes)) if r.length % item else
               record_ends(spark, r.path, r.length, end_id, dtype, block_tokens))
        out = out.unionByName(got)
    return out


def cut(files: DataFrame, size: int, item: int) -> DataFrame:
    """(file, block, data): the contents of ``files`` in blocks of ``size`` bytes, without a part of an id at the end.
    They are cut where Spark reads them, so that no batch for Python holds a file whole."""
    whole = F.floor(F.col("length") / item) * item  # bytes of whole ids
    blocks = files.where(F.col("length") >= item).select(
        "path", "content", whole.alias("bytes"),
        F.explode(F.sequence(F.lit(0), (F.ceil(whole / size) - 1).cast("int"))).alias("block"))
    first = F.col("block").cast("bigint") * size
    return blocks.select("path", F.col("block").cast("bigint"), F.substring(
        "content", (first + 1).cast("int"), F.least(F.lit(size), F.col("bytes") - first).cast("int")))


def batched(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """(file, block, n, ends) rows in batches of ``BATCH`` blocks, or fewer with some ``BATCH_ENDS`` end ids."""
    got: list[tuple] = []
    ends = 0
    for row in rows:
        got.append(row)
        ends += len(row[3])
        if len(got) >= BATCH or ends >= BATCH_ENDS:
            yield _ends_batch(got)
            got, ends = [], 0
    if got:
        yield _ends_batch(got)


def _ends_batch(rows: list[tuple]) -> pa.RecordBatch:
    f, k, n, e = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(f), pa.array(k, pa.int64()), pa.array(n, pa.int64()),
                                       pa.array(e, pa.list_(pa.int32()))], names=["file", "block", "n", "ends"])


def block_scan(end_id: int, dtype: str, block_tokens: int):
    """Scan of (file, block, bytes) rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(
            row for b in batches for file, block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2))
            for row in ends_of(file, block, data.as_buffer(), end_id, dtype, block_tokens))

    return scan


def range_scan(end_id: int, dtype: str, block_tokens: int):
    """Scan of (file, first token, tokens) rows, the first token being a block's: one block in memory at a time."""
    item = np.dtype(dtype).itemsize

    def read(file: str, first: int, tokens: int) -> Iterator[tuple]:
        with open("/" + file.removeprefix("file:").lstrip("/"), "rb") as f:
            f.seek(first * item)
            for at in range(first, first + tokens, block_tokens):
                size = min(block_tokens, first + tokens - at) * item
                data = f.read(size)
                if len(data) < size:
                    raise ValueError(f"{file}: shorter than it was listed")
                yield from ends_of(file, at // block_tokens, data, end_id, dtype, block_tokens)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(row for b in batches for r in zip(*(c.to_pylist() for c in b.columns)) for row in read(*r))

    return scan


def record_ends(spark: SparkSession, file: str, length: int, end_id: int, dtype: str, block_tokens: int) -> DataFrame:
    """``block_ends`` of one file of whole ids, by fixed-length records that fill it: blocks may be far smaller."""
    item = np.dtype(dtype).itemsize
    tokens = length // item
    each = next(d for d in range(min(block_tokens, tokens), 0, -1) if tokens % d == 0)

    def split(records: Iterator[tuple[bytes, int]]) -> Iterator[tuple]:
        for data, k in records:
            for f, b, n, e in ends_of(file, k, data, end_id, dtype, block_tokens):
                yield f, b, n, e.tolist()

    return spark.createDataFrame(spark.sparkContext.binaryRecords(file, each * item).zipWithIndex().mapPartitions(split),
                                 _ENDS)


def joined(blocks: DataFrame) -> DataFrame:
    """``blocks`` of the pieces of files, by the numbers that Spark's writer gives them, as blocks of these files."""
    piece = r"-c(\d+)((\.[^/-]*)?)$"
    return blocks.select(
        F.regexp_replace("file", piece, "$2").alias("file"),
        (F.regexp_extract("file", piece, 1).cast("bigint") * (1 << 32) + F.col("block")).alias("block"), "n", "ends")


def stitched(blocks: DataFrame) -> DataFrame:
    """(file, doc_no, start, n_tokens, complete) of every document of the files, end ids not counted.

    The scan over a file's blocks sees four numbers a block; what it finds goes back to the blocks, where the documents
    are made. ``blocks`` is read twice.
    """
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    numbers = blocks.select("file", "block", "n", F.size("ends").alias("c"),
                            F.when(F.size("ends") > 0, F.element_at("ends", -1) + 1).alias("last"))
    found = (numbers.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .withColumn("doc_0", F.coalesce(F.sum("c").over(before), F.lit(0)))
             .withColumn("behind", F.col("at") + F.col("last"))  # place behind the last end id of the block
             .withColumn("open", F.coalesce(F.max("behind").over(before), F.lit(0)))
             .withColumn("final", F.lead("block").over(order).isNull()))
    some = found.where("c > 0").select(F.col("file").alias("_file"), F.col("block").alias("_block"), "at", "open", "doc_0")
    # never by broadcast: the documents of a file would be made where its window ran, or its end ids sent to every task
    ended = (blocks.select("file", "block", "ends").where(F.size("ends") > 0).hint("merge")
             .join(some.hint("merge"), (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
             .select("file", "at", "open", "doc_0", "ends", F.posexplode("ends").alias("k", "end")).select(
        "file", (F.col("doc_0") + F.col("k")).alias("doc_no"),
        F.when(F.col("k") == 0, F.col("open")).otherwise(
            F.col("at") + F.get("ends", F.col("k") - 1) + 1).alias("start"),
        (F.col("at") + F.col("end")).alias("to"), F.lit(True).alias("complete")))
    tail = found.where("final").select(
        "file", (F.col("doc_0") + F.col("c")).alias("doc_no"), F.coalesce("behind", "open").alias("start"),
        (F.col("at") + F.col("n")).alias("to"), F.lit(False).alias("complete")).where("to > start")
    return ended.unionByName(tail).select("file", "doc_no", "start", (F.col("to") - F.col("start")).alias("n_tokens"),
                                          "complete")


def counts(spark: SparkSession, path: str, end_id: int = END_ID, dtype: str = DTYPE,
           block_tokens: int = BLOCK_TOKENS, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Token counts of the documents in the flat files under ``path``. The files are read once; the few numbers that
    each block gives are checkpointed."""
    return stitched(checkpointed(block_ends(spark, path, end_id, dtype, block_tokens, file_bytes)))


def of_documents(docs: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Writes the documents as flat files to the shared folder, counts them there, and removes the files."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flat-tokens-{uuid.uuid4().hex}"
    if in_file_store(spark, path):
        write_flat(docs, path, text, tokenizer)
        out = counts(spark, path)
    else:  # a task of the scan takes a file whole
        write_flat(docs, path, text, tokenizer, piece_rows=PIECE_ROWS)
        out = stitched(joined(checkpointed(block_ends(spark, path))))
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return out

"""Documents to training sequences in five stages, each a whole-corpus operator of ``recheck.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. A
stage's result is written as Parquet to the folder of spark.checkpoint.dir and read again as the next stage's ``docs``,
so a lost executor costs tasks of one stage only.

Cases: an empty table, NULL texts and ids, repeated rows and extra columns go through as each operator says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from recheck.llm import exact_dedup, mixing, packing, quality_rules, simhash
from recheck.llm.common import checkpointed, table
from recheck.session import ensure_checkpoint_dir

# Tokenizers, fingerprint hashes and hash offsets are not functions of DuckDB.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality_rules.keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints are linked the one with the smallest doc_id stays."""
    return simhash.dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target asks for."""
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs, special=True)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_dedup", near), ("mixing", mixed),
          ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}"), True)
    out = checkpointed(STAGES[-1][1](spark, docs, sf_dir))
    files.delete(top, True)
    return out

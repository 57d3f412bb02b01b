"""The rule predicates are plain Columns: the same rule set runs on a streaming DataFrame."""

import tempfile

from recheck.operators import rules as RU

CONTRACT = [("name", "object", "Y", None), ("ptype", "object", "N", "A,B")]


def test_rules_on_a_stream_equal_batch(spark):
    base = tempfile.mkdtemp(prefix="recheck-stream-", dir="/tmp")
    df = spark.createDataFrame([(1, "nut", "A", "NET30"), (2, None, "C", None), (3, "unknown", "B", "net 5")],
                               "row_id long, name string, ptype string, payment_term string")
    df.write.parquet(base + "/in")
    lk = spark.createDataFrame([("nut", "x", "A", "nut", "no", 1.0, "no")],
                               "normalized_name string, level_5 string, normalized_uom string, original_name string, "
                               "remove_flag string, price double, price_outlier string")
    roles = {"sku_normalized": "name", "sku_original": "name"}
    batch = RU.build_rules(spark.read.parquet(base + "/in"), CONTRACT, norm_lookup=lk, roles=roles).violations()
    stream_in = spark.readStream.schema(df.schema).parquet(base + "/in")
    sv = RU.build_rules(stream_in, CONTRACT, norm_lookup=lk, roles=roles).violations()
    q = (sv.writeStream.format("memory").queryName("recheck_stream_v").outputMode("append")
         .option("checkpointLocation", base + "/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {tuple(r) for r in spark.sql("SELECT row_id, field, rule, message FROM recheck_stream_v").collect()}
    assert got == {tuple(r) for r in batch.collect()} and len(got) > 0

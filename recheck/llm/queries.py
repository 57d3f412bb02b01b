"""The queries of this package: each applies one operator to its whole table; oracles where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recheck.llm import (
    exact_dedup, fill_middle, hard_negatives, language_id, mixing, packing, quality_model, quality_rules, sharding,
    simhash, substring_dedup, token_counts, url_filter,
)
from recheck.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs)).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


WORD_SQL = r"'[^\x20\x09-\x0D]+'"

OP5_SQL = rf"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORD_SQL}) AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {WORD_SQL})) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p : p + 7], ' ') AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS p FROM w)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n
  FROM (SELECT doc_id, unnest(range(p, p + 8)) AS q FROM twice) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, t, words, lines, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id),
b AS (SELECT *, n_words < 20 OR n_repeat_words * 100 > n_words * 30 AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR NOT (word_chars BETWEEN n_words * 2.5 AND n_words * 12.0)
    OR n_symbols * 10 > n_words
    OR n_dup_lines * 2 > len(lines)
    OR len(list_filter(words, lambda x: upper(x) = lower(x) AND NOT regexp_matches(x, '\pL'))) * 10 > n_words * 2
    OR len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) * 2 > n_words
    OR len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\t]*[-*•●]'))) * 10 > len(lines) * 9
    OR len(list_filter(lines, lambda x: ends_with(rtrim(x), '...') OR ends_with(rtrim(x), '…'))) * 10 > len(lines) * 3
  ) AS kept
FROM b"""


@query("op5_quality_rules", OP5_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.scored(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))
         AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""


@query("op6_exact_dedup", OP6_SQL)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORD_SQL})) AS size FROM documents),
own AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
  FROM d GROUP BY source),
w AS (SELECT *, (k % 3 + 1)::DOUBLE AS weight, (3 * source_size)::DOUBLE AS top FROM own),
shares AS (
  SELECT *, coalesce(sum(top) OVER (ORDER BY top / weight, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)
            AS spent,
         sum(weight) OVER (ORDER BY top / weight, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
         (sum(source_size) OVER ())::DOUBLE AS words
  FROM w),
goal AS (
  SELECT source, source_size, least(top, max((words - spent) / open) OVER () * weight) AS target,
         (('0x' || substring(md5('{mixing.SEED}' || CASE WHEN source IS NULL THEN '-' ELSE '+' || source END), 1, 4))
            ::INT + 0.5::DOUBLE) / 65536.0::DOUBLE AS u
  FROM shares),
numbered AS (
  SELECT d.doc_id, d.source, d.size, g.source_size, g.target, g.u, length(bin(d.size)) AS power,
         (row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id NULLS LAST) - 1)::DOUBLE AS x,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS r
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
first AS (SELECT *, (floor((x + 1) * r + u) - floor(x * r + u))::BIGINT AS copies FROM numbered),
powers AS (
  SELECT source, power, sum(size) AS words, sum(size * copies) AS taken, count(*) AS docs, max(target) AS target,
         max(source_size) AS source_size, max(r) AS r, max(u) AS u
  FROM first GROUP BY source, power),
sums AS (
  SELECT *, sum(words) OVER (PARTITION BY source ORDER BY power) AS low,
         coalesce(sum(taken) OVER above, 0) AS high, coalesce(sum(docs) OVER above, 0)::DOUBLE AS larger
  FROM powers
  WINDOW above AS (PARTITION BY source ORDER BY power ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
cut AS (
  SELECT source, power AS small, larger, larger * r + u AS reached,
         CASE WHEN low > 0 THEN least(3.0::DOUBLE, greatest(0.0::DOUBLE, (target - high::DOUBLE) / low::DOUBLE))
              ELSE 0.0::DOUBLE END AS rate
  FROM sums WHERE low >= source_size * 0.25::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY power) = 1),
seam AS (SELECT *, (floor((reached - floor(reached)) * 65536.0::DOUBLE) + 0.5::DOUBLE) / 65536.0::DOUBLE AS b FROM cut)
SELECT f.doc_id, f.size, f.source_size, f.target,
       f.size * (CASE WHEN f.power <= c.small
                      THEN (floor((x - larger + 1) * c.rate + b) - floor((x - larger) * c.rate + b))::BIGINT
                      ELSE f.copies END) AS taken
FROM first f JOIN seam c ON f.source IS NOT DISTINCT FROM c.source"""


@query("op8_mixing", OP8_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "block_score")


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), special=True)


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.of_documents(table(spark, sf_dir, "documents")).select(
        F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("file_no"), "doc_no", "start", "n_tokens",
        "complete")


OP2_SQL = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD_SQL}) AS words FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(words[p : p + 49], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM w)),
firsts AS (SELECT k, min(doc_id) AS lo FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i
  FROM windows JOIN firsts ON windows.k = firsts.k WHERE doc_id > lo),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) e
  ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT w.doc_id, len(w.words) AS n_words, len(w.words) - coalesce(kept.n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id"""


@query("op2_substring_dedup", OP2_SQL)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


# A token of fill-in-the-middle: a word with the white space before it, or white space at the end.
TOKEN_SQL = r"'[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'"

OP11_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('{fill_middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), {TOKEN_SQL}) AS u
  FROM documents),
k AS (
  SELECT doc_id, t, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS c1,
         ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS c2,
         CASE WHEN t = '' OR regexp_matches(t, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
parts AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1 : least(c1, c2)], ''), '') AS p,
         coalesce(array_to_string(u[least(c1, c2) + 1 : greatest(c1, c2)], ''), '') AS m,
         coalesce(array_to_string(u[greatest(c1, c2) + 1 : n], ''), '') AS s
  FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM parts"""


@query("op11_fill_middle", OP11_SQL)
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transform(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op12_quality_model")
def op12_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.predict(docs, quality_model.fit(docs, labels)).select(
        "doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


OP13_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


@query("op13_hard_negatives", OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    relabelled = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(
        F.col("label")))
    return hard_negatives.mine(relabelled, F.col("vec_id") % 50 == 0)

"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (bpe, chat, embed_dedup, exact_dedup, packing, periodic, prefix_trie, quality, simhash,
                          substring_dedup, suffix_dedup, toxicity, warc)
from tidemark.llm.common import saved, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passage_dedup(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_warc(warc.archived(table(spark, sf_dir, "pages")), with_payload=False)
    return records.select(warc.page_id(F.col("record_id")).alias("page_id"), "payload_bytes",
                          F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), "record_type",
                          warc.page_id(F.col("refers_to")).alias("refers_to"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_groups(table(spark, sf_dir, "documents"), "doc_id", exact_dedup.ascii_lower(F.col("text")))
    return out.withColumnRenamed("digest", "text_sha256")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chat(table(spark, sf_dir, "conversations"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.vector_links(table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", (~toxicity.training_part(F.col("doc_id"))).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.periodic_runs(table(spark, sf_dir, "documents"), rewrite=periodic.repeated_tail)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    out = out.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held_out = F.coalesce(~quality.training_part(F.col("doc_id")), F.lit(True))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = saved(prefix_trie.digests(table(spark, sf_dir, "conversations")), "turn-digests")
    return prefix_trie.prefix_trie(prefix_trie.with_family_heads(numbered)).drop("path")


QUERIES = {f.__name__: f for f in (op1_packing, op2_suffix_dedup, op3_paragraph_dedup, op4_warc, op5_simhash, op6_exact_dedup,
                                   op7_chat, op8_embedding_dedup, op9_toxicity, op10_bpe, op11_periodic_runs, op12_quality,
                                   op13_prefix_trie)}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FIVE = "('0x' || substr(sha1(coalesce(html, '')), 5 * i + 1, 5))::BIGINT"  # 20 bits: four base-32 digits
_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({five} >> {shift}) & 31)::INTEGER + 1, 1)"
_BASE32 = ("array_to_string(list_transform(range(0, 8), lambda i: "
           + " || ".join(_DIGIT.format(five=_FIVE, shift=s) for s in (15, 10, 5, 0)) + "), '')")

# crc32 of a number's decimal digits, bit by bit
_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({c}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), "
          "lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
          "lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)")

SQL = {
    "op6_exact_dedup": f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g USING (t)""",
    "op4_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, {_BASE32} AS payload_digest FROM pages),
f AS (SELECT h, min(page_id) AS least FROM p GROUP BY h)
SELECT page_id, strlen(h) AS payload_bytes, payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to
FROM p JOIN f USING (h)""",
    "op13_prefix_trie": f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST) - 1 AS place
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32.format(c="conv_id")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY own, place) AS depth
      FROM (SELECT c.conv_id, 0 AS own, place, role, text FROM c JOIN t ON t.conv_id = base AND place < h
            UNION ALL SELECT conv_id, 1, place, role, text FROM c JOIN t USING (conv_id) WHERE place >= h)),
m AS (SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
             list((role, text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM r
      UNION ALL SELECT conv_id, 0, 0, [] FROM c),
n AS (SELECT path, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs, any_value(words) AS words FROM m GROUP BY path),
k AS (SELECT n.*, p.conv_id AS parent_conv_id, count(*) FILTER (WHERE n.depth > 0) OVER (PARTITION BY p.path) AS siblings, p.path AS above
      FROM n LEFT JOIN n AS p ON p.path = n.path[:-2] AND n.depth > 0),
f AS (SELECT above AS path, any_value(siblings) AS n_children FROM k WHERE depth > 0 GROUP BY above),
s AS (SELECT m.path, sum((u.n_convs - 1) * u.words) AS saved_tokens, count(*) FILTER (WHERE f.path IS NULL) AS n_leaves
      FROM n AS u JOIN m ON m.conv_id = u.conv_id AND m.depth <= u.depth LEFT JOIN f ON f.path = u.path GROUP BY m.path),
e AS (SELECT path, string_agg(conv_id, ',' ORDER BY conv_id) AS ends
      FROM m JOIN (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id) USING (conv_id, depth) GROUP BY path)
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, coalesce(f.n_children, 0) AS n_children, s.n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
FROM k JOIN s USING (path) LEFT JOIN f ON f.path = k.path LEFT JOIN e ON e.path = k.path""",
}

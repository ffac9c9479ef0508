"""Exact dedup: skew-safe combining of digest groups, native DataFrame functions only.

1. Each map task combines its own equal texts (partial aggregation with the text in the key).
2. Copies meet in groups of (digest, salt, text): a text held by a third of all rows is spread
   over ``salts`` reducers, each of which keeps one winner.
3. The salt winners, at most ``salts`` per text, are combined per (digest, text).

The text itself is part of every grouping key, so equal digests alone never merge rows.  The
decision goes back to the rows through the digest; a digest that stands for two different texts
stops the job instead of merging them.

Defined results: a null text counts as empty; the null id loses to every id; when all ids of a
group are null, keep_id is null and all its rows are kept; rows that repeat the winning id are
all kept (they are the same row); empty input gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import same

SALTS = 16


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_groups(df: DataFrame, id_col: str, text: Column, salts: int = SALTS) -> DataFrame:
    """One row per row of ``df``: (id, keep_id, group_size, kept, digest); the largest id of
    equal ``text`` stays."""
    base = df.select(F.col(id_col).alias("_id"), text.alias("_text"))
    rows = base.select("_id", "_text", F.sha2("_text", 256).alias("_digest"))
    salted = (rows.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)))
              .groupBy("_digest", "_salt", "_text")
              .agg(F.max("_id").alias("_top"), F.count(F.lit(1)).alias("_n")))
    winners = (salted.groupBy("_digest", "_text")
               .agg(F.max("_top").alias("_top"), F.sum("_n").alias("_n")))
    by_digest = (winners.groupBy("_digest")
                 .agg(F.max("_top").alias("keep_id"), F.sum("_n").alias("group_size"),
                      F.count(F.lit(1)).alias("_texts"))
                 .withColumn("group_size", F.when(F.col("_texts") == 1, F.col("group_size"))
                             .otherwise(F.raise_error(F.lit("two texts share a digest")).cast("long")))
                 .drop("_texts"))
    return (rows.select("_id", "_digest").join(by_digest, "_digest")
            .select(F.col("_id").alias(id_col), "keep_id", "group_size",
                    same(F.col("_id"), F.col("keep_id")).alias("kept"), F.col("_digest").alias("digest")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that lose in their group (all columns kept)."""
    text = ascii_lower(F.col(text_col))
    groups = exact_groups(docs, id_col, text)
    lost = groups.filter(~F.col("kept")).select(F.col(id_col).alias("_lost"), F.col("digest").alias("_of")).distinct()
    keyed = docs.withColumn("_digest", F.sha2(text, 256))
    return keyed.join(lost, (keyed["_digest"] == lost["_of"]) & same(keyed[id_col], lost["_lost"]), "left_anti").drop("_digest")

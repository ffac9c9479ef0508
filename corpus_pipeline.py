"""The corpus pipeline: each stage reads what its predecessor wrote."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, simhash, suffix_dedup, toxicity
from tidemark.llm.common import saved, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores at 0.5 or above go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash links at two bits or fewer, the smallest doc_id stays."""
    return simhash.drop_near_copies(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated 100-byte strings go, but for their first occurrence."""
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences (the last stage: its rows are no documents)."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", remove_repeated_passages),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained score, fingerprints and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs

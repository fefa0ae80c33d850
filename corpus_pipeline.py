"""Documents to packed training sequences: five stages, each written and read again.

Every stage works on all documents that its predecessor kept; the first four return
documents with all their columns, the last one the pieces of the sequences. Nulls, empty
texts, repeated rows and empty tables behave as each operator's docstring says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopgrain.llm import exact_dedup, hyperminhash, packing, quality_rules, string_kernel
from shopgrain.llm.common import settled

#: Documents whose best language scores below this are in none of the learned ones.
LEAST_LANGUAGE_SCORE = 0.4
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: SQL cannot express the language, near-duplicate and packing stages; tests compare
#: the rows with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard quality policy keeps."""
    return quality_rules.filtered(docs, quality_rules.STANDARD)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from these documents."""
    return string_kernel.known(docs, string_kernel.train(docs), least=LEAST_LANGUAGE_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return hyperminhash.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens, and their places in the sequences."""
    return packing.packed(docs, TOKENIZER)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, the intermediate ones written in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for _, stage in first:
        docs = settled(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)

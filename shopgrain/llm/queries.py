"""Queries of this subpackage over a folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import (
    conversation_repair,
    exact_dedup,
    html_mincut,
    hyperminhash,
    license_scan,
    packing,
    prefix_trie,
    quality_rules,
    sentencepiece_bpe,
    string_kernel,
    toxicity_gru,
    url_graph,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.groups(table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.digest(table(spark, folder, "documents"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_bpe.digests(table(spark, folder, "documents"), path)


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_graph.judged(table(spark, folder, "pages")).drop("host_trust", "host_distrust")


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_mincut.extracted(table(spark, folder, "pages"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return string_kernel.predicted(docs, string_kernel.train(docs))


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.groups(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of their source's directory."""
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", "doc_id")
    return license_scan.scanned(docs.select("doc_id", "text", path.alias("path")), "doc_id")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, folder, "conversations"))
    return conversation_repair.repaired(rows, there=F.col("there"))


def op12_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity_gru.scored(docs, toxicity_gru.train(docs, table(spark, folder, "labels")))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, folder, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_exact_dedup,
            op2_warc,
            op3_quality_rules,
            op4_sentencepiece,
            op5_url_filters,
            op6_html_extraction,
            op7_language_id,
            op8_minhash_near_dedup,
            op9_best_fit_packing,
            op10_license_scan,
            op11_conversation_repair,
            op12_toxicity,
            op13_conversation_trie,
        )
    }

"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callflow.llm import (
    bpe_automaton,
    embedding_links,
    histogram_packing,
    html_extraction,
    jaccard_join,
    merkle_manifest,
    oracle,
    prefix_trie,
    quality_cascade,
    repeated_spans,
    sharding,
    token_files,
    toxicity_chain,
    window_packing,
)
from callflow.llm.shared import read


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The public tokenizer that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.extract_pages(read(spark, folder, "pages"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, folder, "documents")).drop("hash")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_cascade.document_quality(read(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return window_packing.pack_documents(read(spark, folder, "documents"), tokenizer_path())


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_digests(read(spark, folder, "documents"), tokenizer_path())


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_chain.document_toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_automaton.document_digests(read(spark, folder, "documents"), tokenizer_path())


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(read(spark, folder, "documents"))


def op9_repeated_spans(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans.span_digests(read(spark, folder, "documents"))


def op10_embedding_links(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links.link_vectors(read(spark, folder, "embeddings"))


def op11_histogram_packing(spark: SparkSession, folder: str) -> DataFrame:
    return histogram_packing.pack_documents(read(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.document_proofs(read(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.conversation_trie(read(spark, folder, "conversations"))


ALL = {
    "op1_html_extraction": op1_html_extraction,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_token_files": op5_token_files,
    "op6_toxicity": op6_toxicity,
    "op7_bpe": op7_bpe,
    "op8_sharding": op8_sharding,
    "op9_repeated_spans": op9_repeated_spans,
    "op10_embedding_links": op10_embedding_links,
    "op11_histogram_packing": op11_histogram_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE = dict(oracle.ALL)

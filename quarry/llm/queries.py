"""The registered queries of the operators of this subpackage.

Each query applies its operator with production parameters to the whole of its
table and returns one digest row per document, page or conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import chat, decontam, html, jaccard, licences, merkle, mixing, quality, secrets, tokens, toxicity, trie, warc
from quarry.llm.common import table, written
from quarry.llm.oracle import ORACLE  # noqa: F401 - registered with the queries


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenizes, writes and reads back every document."""
    return tokens.read_tokens(tokens.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path()))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality verdict on every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return secrets.secret_digests(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back."""
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract_main_text(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that overlap."""
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    return chat.chat_digests(written(chat.format_chat(turns.unionByName(more)), "chat"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix trie of all conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with the roots that each one folds to."""
    return merkle.merkle_manifest(table(spark, sf_dir, "documents"), with_proof=False)


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences named or quoted in every document."""
    return licences.licence_digests(licences.scan_licences(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (
    op1_token_ids, op2_quality_rules, op3_mix_sources, op4_secret_scan, op5_warc, op6_toxicity, op7_ngram_jaccard,
    op8_main_text, op9_decontamination, op10_chat_format, op11_prefix_trie,
    op12_merkle_manifest, op13_license_scan)}

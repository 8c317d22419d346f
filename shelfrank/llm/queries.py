"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.llm import (
    chat_repair,
    fingerprints,
    jaccard,
    langid,
    main_text,
    merkle,
    near_vectors,
    packing,
    piece_sampling,
    quality,
    token_store,
    tool_calls,
    url_rules,
)
from shelfrank.llm.common import table
from shelfrank.session import scratch_path


def tokenizer_path() -> str:
    """The public tokenizer of the registered queries."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every document and of its edited text, and their likeness."""
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids by best-fit decreasing."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as Re-Pair blocks and read back from them."""
    path = scratch_path(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_store.read(spark, path)


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by fixed and mined rules."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rows, names = url_rules.judge(pages, url_rules.mine(pages, table(spark, sf_dir, "labels")))
    return rows.select("page_id", *(names[c] for c in ("host", "path", "rule", "verdict", "mined_rule")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document under the learned decision list."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn(docs, table(spark, sf_dir, "labels"))
    rows, names = quality.judge(docs, rules)
    return rows.select("doc_id", *(names[c] for c in (*quality.COUNTS, "base_failed", "kept", "rule")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document under the models learned from the others."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows, (lang, score, _) = langid.identify(docs.drop("lang"), langid.train(docs))
    return rows.select("doc_id", langid.held_out().alias("held_out"), F.col(lang), F.col(score))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links of word 5-gram Jaccard >= 0.75."""
    return jaccard.classes(table(spark, sf_dir, "documents"))


def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results of all conversations linked, ordered and validated."""
    turns = table(spark, sf_dir, "conversations")
    calls, results = tool_calls.conversation_calls(turns), tool_calls.conversation_results(turns)
    return tool_calls.link(calls, results, tool_calls.TOOLS)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by boosted trees over its DOM nodes."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    rows, (text, n_chars) = main_text.extract(pages, main_text.train(pages))
    return rows.select("page_id", "url", text, n_chars)


def op9_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every document, seeded by its id, and whether
    decoding gives the text back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, names = piece_sampling.segment(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return rows.select("doc_id", *names)


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector under cosine >= 0.93 within its label."""
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root after tampering."""
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return chat_repair.repair(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_packing": op2_packing,
    "op3_token_store": op3_token_store,
    "op4_url_rules": op4_url_rules,
    "op5_quality_rules": op5_quality_rules,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_tool_calls": op7_tool_calls,
    "op8_main_text": op8_main_text,
    "op9_piece_sampling": op9_piece_sampling,
    "op10_language_id": op10_language_id,
    "op11_near_vectors": op11_near_vectors,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL: dict[str, str] = {}

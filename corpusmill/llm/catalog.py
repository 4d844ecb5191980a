"""Registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, chat_snapshots, conversation_repair, exact, html_text, langid, partenum, simhash, suffix, token_alignment, url_templates, weak_quality, winnow

RANKS = "byte_bpe_50k.tiktoken"
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = exact.exact_groups(docs, keep="largest")
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix.remove_repeats(docs, contents=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "page_text")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.encode_decode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_templates.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", "labels", "purity")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = winnow.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~langid.held_out()))
    out = langid.predict(docs.select("doc_id", "text", langid.held_out().alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return partenum.similarity_components(docs).select("doc_id", "n_shingles", "component_id")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return weak_quality.quality(docs).select("doc_id", "votes", "weak_label", "score", "good")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_snapshots.format_conversations(_table(spark, sf_dir, "conversations"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    damaged = conversation_repair.damage(turns)
    found = conversation_repair.audits(damaged, all_ids=turns)
    return conversation_repair.with_digests(damaged, found)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_suffix_dedup,
        op3_html_extraction,
        op4_byte_bpe,
        op5_url_filter,
        op6_decontamination,
        op7_language_id,
        op8_jaccard_join,
        op9_quality,
        op10_chat_format,
        op11_conversation_repair,
        op12_simhash,
        op13_token_alignment,
    )
}

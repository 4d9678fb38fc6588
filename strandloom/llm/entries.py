"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import byte_bpe, fingerprints, html_extract, language_id, near_dedup, packing, pii, prefix_trie, quality_rules, suffix_dedup, token_store, url_filter, whitening
from strandloom.llm._common import crc_remainder, scratch, table

#: The key of the registered queries' surrogates; a user passes an own, secret one.
PII_SECRET = "registered-query-key"
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


URL_RULES = tuple(
    url_filter.Rule(*r)
    for r in (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.seed_labels(pages))
    return url_filter.judge(pages, URL_RULES, model).select("page_id", "host", "path", "rule", "verdict", "score")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.train_split(docs))
    rows = docs.select("doc_id", "text", (crc_remainder("doc_id") == 2).alias("held_out"))
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality_rules.apply(table(spark, sf_dir, "documents")).select("doc_id", *counts, "base_failed", "kept")


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-store")
    token_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_BPE), end_id=2)
    return token_store.read(spark, path)


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace(table(spark, sf_dir, "documents"), PII_SECRET).select("doc_id", "text", "n_entities")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=0, capacity=2048)


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_html_text": op6_html_text,
    "op7_token_store": op7_token_store,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_spotsigs": op10_spotsigs,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": quality_rules.oracle_sql(),
    "op5_minhash_dedup": near_dedup.oracle_sql(words=3, percent=85),
    "op11_prefix_trie": prefix_trie.oracle_sql(),
}

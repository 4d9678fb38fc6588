"""Corpus preparation from end to end: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns
of ``documents`` (doc_id, text, lang, source, n_chars). ``run`` writes each stage's rows to the shared
folder and reads them back for the next, so a lost executor costs a stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import language_id, near_dedup, packing, pii, quality_rules
from strandloom.llm._common import materialise, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language is less likely than this is in none that was learned.
LEAST_SCORE = 0.3
#: The key of this corpus's surrogates; a user sets an own, secret one.
SECRET = "corpus-pipeline-key"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter and texts in no learned language; set ``lang`` to what was found."""
    model = language_id.fit(language_id.train_split(docs))
    found = language_id.predict(docs, model)
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail a quality rule."""
    return quality_rules.apply(docs).where("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five-word shingles, similarity 0.8 or more.

    Of rows with one ``doc_id`` and one text, one is kept. Only rows whose ``doc_id`` occurs more than once are compared for that.
    """
    gone = near_dedup.link(docs, words=5, percent=80).where("not kept").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)
    twice = docs.groupBy(F.col("doc_id").alias("id")).count().where("`count` > 1").select("id")
    if twice.isEmpty():
        return kept
    same = F.col("doc_id").eqNullSafe(F.col("id"))
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by surrogates; ``n_chars`` follows the new text."""
    return pii.replace(docs, SECRET).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' token ids into sequences of 2048: a row for each piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=0, capacity=2048)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("quality", apply_quality_rules),
    ("near-duplicates", drop_near_duplicates),
    ("personal-data", replace_personal_data),
    ("packing", pack_sequences),
]

#: Models, hashes and a tokenizer library aren't SQL; tests/llm holds stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

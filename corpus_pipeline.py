"""A corpus pipeline over ``documents``: language, exact copies, near copies, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``. No stage changes a document that it has nothing against.
Rows with nulls, repeated rows and empty tables go through as each stage's operator says; an empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areapanel.llm import bounded_batches, exact_dedup, jaccard_join, language_id, packing, pii
from areapanel.session import write_scratch


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model recognises; null texts, texts without letters and doubtful ones go."""
    bounded_batches(spark)
    model = language_id.train(docs, ~language_id.held_out("doc_id"))
    return language_id.keep_identified(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of texts that are equal but for white space."""
    bounded_batches(spark)
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group whose five-word shingles link at a similarity of 0.8."""
    bounded_batches(spark)
    return jaccard_join.one_of_each(docs, jaccard_join.jaccard_join(docs, width=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind, and n_chars to match."""
    return pii.redact(docs, "text").withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 2048."""
    bounded_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact_copies), ("ngram_jaccard_join", near_copies),
          ("pii", personal_data), ("packing", pack)]

#: Models and tokenizers have no SQL; tests/llm/test_pipeline.py checks the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = write_scratch(docs, f"stage-{name}")
    return docs

"""A corpus pipeline: toxic documents out, repeated lines out, near-duplicates out, benchmark leaks out, then tokens.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir), and what it
returns is written as Parquet and read again as the next one's ``docs``.

Stages take tables with nulls in any column, repeated rows, extra columns of any
name, and no rows; all but the last return the columns of documents. Null and
empty texts are scored by the model's bias, lose no lines, are near-duplicates
of each other, hold no passage and have no tokens. Rows with a null id come
after all others where the first is kept. Ids that repeat name a document
together with its text, so identical rows share what is decided.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import bpe, decontaminate, linededup, neardup, toxicity
from weftline.session import small_batches, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5, by a model learnt from the labelled ones among them."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_documents(docs, labels).filter("score < 0.5").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that come after the first of their class; those that had only such lines go. ``n_chars`` follows the text."""
    small_batches(spark)
    kept = linededup.dedup_lines(docs).filter(~((F.col("n_lines_removed") > 0) & F.coalesce(F.col("text"), F.lit("")).rlike(r"\A\s*\z")))
    return kept.withColumn("n_chars", F.when(F.col("n_lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles of a Jaccard similarity of 0.8 or more link: the first by id, then by a hash of the text."""
    small_batches(spark)
    return neardup.one_of_each(docs).select(*COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of any benchmark item."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document that is left."""
    small_batches(spark)
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("bpe", as_tokens),
]

#: Line classes, near-duplicates and BPE are beyond SQL; ``tests/llm/test_brute_force.py`` recomputes all stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs

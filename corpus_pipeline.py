"""The corpus pipeline: toxic documents go, near-duplicates go, contaminated documents go, personal data is masked, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import table, written
from cohortry.llm.decontamination import mark_contaminated
from cohortry.llm.near_duplicates import one_of_each
from cohortry.llm.packing import pack_documents
from cohortry.llm.personal_data import redact
from cohortry.llm.toxicity import score_toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return score_toxicity(docs, table(spark, sf_dir, "labels")).filter(F.col("score") < TOXIC).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle sets with a similarity of 0.8 or more stays."""
    return one_of_each(docs.select(*COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mark_contaminated(docs, table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The workers go on with other stages: no memory of pieces stays behind.
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), special=True, lasting=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

# Trained classifiers and tokenizers are beyond SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

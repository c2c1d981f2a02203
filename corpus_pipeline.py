"""Corpus pipeline over ``documents``; each stage's rows are written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rrspark.llm import langid, packing, pii, simhash, toxicity
from rrspark.llm.common import stage, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these rows and their labels, calls toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: no letter, or a posterior under 0.5."""
    return langid.keep_identified(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest doc_id."""
    return simhash.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; n_chars follows the new text (null texts keep theirs)."""
    out = pii.pseudonymise(docs, pii.session_key(spark))
    chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return out.withColumn("n_chars", chars).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences, as op8 returns them."""
    return packing.packed_digest(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("simhash_dedup", simhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # trained models, XXH64 and byte-pair encoding are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

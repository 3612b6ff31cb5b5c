"""A corpus pipeline of five operators; each stage reads what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seamwright.durable import discard, durable, latest, scratch
from seamwright.llm import exact_dedup, langid, mixing, ngram_join, sp_codec
from seamwright.llm.common import table

#: Two stages need models (n-grams, a tokenizer), so the rows aren't expressible in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a recognisable language; the model learns from the labelled ones among docs."""
    return langid.accepted(docs, langid.trained(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.distinct_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays; rows without doc_id stay."""
    return ngram_join.distinct_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights; a document appears as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every document of the mix."""
    return sp_codec.encode(docs, keep=("lang", "source")).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "misses")


STAGES = [("language", language), ("exact_dedup", exact), ("ngram_join", near), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage wrote on its way, and the stage before it, are deleted once its own table is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
        if last:
            discard(spark, [last])
        last = latest(spark)
    return STAGES[-1][1](spark, docs, sf_dir)

"""A corpus from raw documents to token ids: rules, toxicity, near-duplicates, benchmark passages, encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents
that it keeps, with the columns of ``documents``; the last returns the encoded documents. ``run``
writes each stage's result to the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scholion.llm import decontamination, near_dedup, quality_rules, toxicity
from scholion.llm.common import stored, table
from scholion.llm.queries import encoded_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded_digests(docs)


STAGES = [("quality_rules", quality), ("toxicity", harmless), ("near_dedup", distinct),
          ("decontamination", decontaminated), ("byte_bpe", encoded)]
#: A trained classifier, sketches and merges of ranks have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

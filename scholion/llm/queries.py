"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.llm import alignment, bpe, collocations, decontamination, html_extract, language_id, lm_scoring, near_dedup, quality_rules, sharding, token_counts, toxicity, word_bpe
from scholion.llm import oracles as oracles_sql
from scholion.llm.common import table

SHARDS = 8
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE, PIECE_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sample_edits(text: str = "text"):
    """Three edits of a document, drawn from its own text: a cut, an insertion, a replacement."""
    body = F.coalesce(F.col(text), F.lit(""))
    n = F.char_length(body).cast("long")
    part = lambda share, size: F.substring(body, F.floor(n / share).cast("int") + 1, size)
    step = lambda at, removed, inserted: F.struct(F.floor(at).cast("long").alias("at"), removed.cast("long").alias("removed"), inserted.alias("inserted"))
    return F.array(step(n / 3, 5 + n % 7, F.lit("")), step(n / 2, F.lit(0), part(4, 12)), step(2 * n / 3, F.lit(4), F.upper(part(5, 6))))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count(docs.withColumn("edits", sample_edits()), RANKS, PATTERN)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extract.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), SHARDS)


def encoded_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the checksums of the ids and of the bytes that they decode to."""
    back = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = word_bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE, decoded=True)
    return texts.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
    return found.withColumn("groups_sha256", F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))).drop("groups")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_language_id, op3_quality_rules, op4_html_extraction, op5_lm_scoring, op6_sharding, op7_order_minhash,
    op8_byte_bpe, op9_toxicity, op10_decontamination, op11_word_bpe, op12_collocations, op13_alignment, pipeline)}
ORACLES = {"op3_quality_rules": oracles_sql.QUALITY, "op6_sharding": oracles_sql.sharded(SHARDS),
           "op10_decontamination": oracles_sql.DECONTAMINATION, "op12_collocations": oracles_sql.COLLOCATIONS}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)

"""Final merge: payloads of the three routes attached to the samples of each document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.functions.arrays import sort_by
from scholion.functions.text import has_text, strip
from scholion.operators.entities import CHARACTERIZATION, PROPERTY, STEP, table_schema
from scholion.operators.merge import MERGE, as_metrics

PAYLOAD_TYPE = {"char": table_schema(CHARACTERIZATION), "prop": T.ArrayType(table_schema(PROPERTY)),
                "proc": T.ArrayType(table_schema(STEP))}
ROUTES = ("char", "prop", "proc")
COLUMN = {"char": "characterization", "prop": "properties", "proc": "process"}
SAMPLE_KEYS = ["doc_id", "sample_id"]


def payloads_by_sample(after: DataFrame, route: str, **options) -> DataFrame:
    """One payload per (doc_id, sample_id); duplicates merge in order of ``ord``."""
    rows = after.select(
        strip(F.col("doc_id")).alias("doc_id"), strip(F.col("sample_id")).alias("sample_id"), "ord", "payload",
    ).where(has_text(F.coalesce("doc_id", F.lit(""))) & has_text(F.coalesce("sample_id", F.lit(""))))
    return MERGE[route](rows, SAMPLE_KEYS, **options)


def empty_payloads(spark, route: str) -> DataFrame:
    """What a missing route file stands for."""
    kind = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("sample_id", T.StringType()),
                         T.StructField("payload", PAYLOAD_TYPE[route])])
    return spark.createDataFrame([], kind)


def _file_keys(main: DataFrame) -> list[str]:
    """Columns that tell the documents apart; files of equal content share ``doc_id``."""
    return [c for c in ("doc_id", "run_id", "doc_index", "file_name") if c in main.columns]


def matched_samples(main: DataFrame, payloads: dict[str, DataFrame]) -> DataFrame:
    """One row per sample with the payloads found for it."""
    rows = main.select(*_file_keys(main), F.posexplode_outer("samples").alias("pos", "s")).withColumn(
        "sample_id", strip(F.col("s.sample_id")))
    for route in ROUTES:
        table = payloads.get(route)
        if table is None:
            table = empty_payloads(main.sparkSession, route)
        rows = rows.join(table.select(*SAMPLE_KEYS, F.col("payload").alias(route)), SAMPLE_KEYS, "left")
    return rows


def final_documents(main: DataFrame, payloads: dict[str, DataFrame]) -> DataFrame:
    """One row per document: literature and samples with their payloads in place.

    Samples and payloads meet on (doc_id, sample_id), so a document with many samples
    spreads out until its own row is put together.
    """
    rows = matched_samples(main, payloads)
    sample = F.struct(
        *[F.col(f"s.{n}").alias(n) for n in ("category_name", "category_code", "name", "sample_form",
                                             "structure_l1", "structure_l2")],
        F.col("char").alias("characterization"),
        *[F.coalesce(F.col(r), F.array().cast(PAYLOAD_TYPE[r])).alias(COLUMN[r]) for r in ("prop", "proc")],
        F.col("s.sample_id").alias("sample_id"))
    keys = _file_keys(main)
    samples = rows.groupBy(*keys).agg(F.transform(
        sort_by(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", sample.alias("s")))), "pos"),
        lambda x: x["s"]).alias("samples"))
    return main.drop("samples").join(samples, keys)


def merge_coverage(main: DataFrame, payloads: dict[str, DataFrame]) -> DataFrame:
    """Documents, samples, payload records and matches per route as (metric, value) rows."""
    rows = matched_samples(main, payloads)
    out = as_metrics(rows.agg(
        F.count("s").alias("sample_count"), *[F.count(r).alias(f"matched_{COLUMN[r]}_count") for r in ROUTES]))
    tables = [("doc_count", main)] + [
        (f"{COLUMN[r]}_record_count", payloads[r]) for r in ROUTES if payloads.get(r) is not None]
    for metric, table in tables:
        out = out.unionByName(as_metrics(table.agg(F.count(F.lit(1)).alias(metric))))
    return out

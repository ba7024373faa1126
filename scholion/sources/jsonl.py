"""JSON-lines tables and the stage/run layout they are kept in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.sources.lines import read_lines

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType, on_bad: str = "fail",
               positions: bool = False) -> DataFrame:
    """Rows of JSON-lines files; blank lines never count.

    ``fail`` stops at a malformed line and names its file and number; ``skip`` leaves such lines
    out. ``positions`` adds ``file`` and ``line``, the order of the rows. Lines are parsed from
    text, so dropping columns later cannot hide a bad line.
    """
    if on_bad not in ("fail", "skip"):
        raise ValueError("on_bad must be 'fail' or 'skip'")
    if positions or on_bad == "fail":
        lines = read_lines(spark, path)
    else:
        lines = spark.read.text(path).select(F.lit("").alias("file"), F.lit(0).alias("line"), "value")
    wide = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    parsed = lines.where(F.trim("value") != "").withColumn(
        "row", F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    )
    bad = F.col(f"row.{CORRUPT}").isNotNull() | ~F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    columns = [F.col(f"row.{f.name}").alias(f.name) for f in schema.fields]
    if positions:
        columns = ["file", "line", *columns]
    if on_bad == "skip":
        return parsed.where(~bad).select(*columns)
    message = F.concat(F.lit("malformed JSON line in "), F.col("file"), F.lit(", line "), F.col("line").cast("string"), F.lit(": "), F.substring("value", 1, 200))
    return parsed.withColumn("row", F.when(bad, F.raise_error(message)).otherwise(F.col("row"))).select(*columns)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line, nulls kept, non-ASCII text as it is."""
    df.write.mode(mode).json(path, ignoreNullFields=False)


def stage_path(base: str, run_id: str, stage: str) -> str:
    """Folder of one stage of one run."""
    return f"{base.rstrip('/')}/stage={stage}/run_id={run_id}"


def sibling(path: str, stage: str) -> str:
    """The folder of another stage of the same run."""
    head, _, rest = path.rpartition("/stage=")
    if not head or "/" not in rest:
        raise ValueError(f"not a stage folder: {path}")
    return f"{head}/stage={stage}/{rest.split('/', 1)[1]}"


def assert_single_run_id(df: DataFrame) -> str:
    """The run id all rows share; an error when it is missing or not unique."""
    low, high, missing = df.agg(
        F.min("run_id"), F.max("run_id"), F.count(F.when(F.coalesce("run_id", F.lit("")) == "", 1))
    ).first()
    if low is None or missing:
        raise ValueError("missing run_id")
    if low != high:
        raise ValueError(f"more than one run_id: {low}, {high}")
    return low


def write_stage(df: DataFrame, base: str, stage: str, mode: str = "errorifexists") -> str:
    """Write a stage table under its run and return the folder."""
    path = stage_path(base, assert_single_run_id(df), stage)
    write_jsonl(df, path, mode)
    return path

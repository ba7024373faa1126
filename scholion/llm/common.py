"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text that is not null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where it is unset a local session, whose threads share one disk, gets a fresh folder of
    its own; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="scholion-shared-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to the shared folder and read again: cuts the lineage,
    survives the loss of executors and gives the planner the true size."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands Python at most so many rows at once, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """Memory that this process has freed goes back to the system; Spark keeps Python workers for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(body: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The body of a task, which gives its memory back at the end."""
    def run(batches: Iterator) -> Iterator:
        yield from body(batches)
        give_back()

    return run


def unused(docs: DataFrame, name: str) -> str:
    """The name, or a longer one where the table has such a column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_key(text: Column) -> Column:
    """Key of a text's content; equal texts get equal keys, null stays null."""
    return F.md5(text.cast("binary"))

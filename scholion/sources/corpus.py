"""Reading a corpus of Markdown files and numbering its rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scholion.session import cut_lineage


def build_raw_corpus(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``*.md`` file of a directory as (file_name, md5, content)."""
    files = spark.read.text(directory, wholetext=True, pathGlobFilter="*.md")
    return raw_rows(files.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("content")))


def raw_rows(files: DataFrame) -> DataFrame:
    """Attach the content hash to (file_name, content) rows."""
    return files.select("file_name", F.md5(F.col("content").cast("binary")).alias("md5"), "content")


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """All Markdown files below ``root`` as (path, content)."""
    files = spark.read.text(root, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def flatten_corpus(files: DataFrame) -> DataFrame:
    """Keep the first file per name stem, in path order: (path, stem, file_name, content).

    The winner is found on paths alone, with a map-side minimum, so a stem that
    many files share costs no more than the others.
    """
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1)).withColumn(
        "stem", F.regexp_replace("file_name", r"(?<=.)\.[^.]+$", "")
    )
    first = named.groupBy("stem").agg(F.min("path").alias("path")).select("path")
    return named.join(first, "path", "left_semi").select("path", "stem", "file_name", "content")


FILE_KEYS = ["run_id", "doc_id", "doc_index"]


def one_per_content(sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sections of the first file of each content, and the list of all files with their content.

    Files of equal content share ``doc_id``; later stages that know documents by it would mix their
    sections and ask the model twice. Only copies are looked for among the sections, so where there
    are few of them no text moves.
    """
    files = sections.select(*FILE_KEYS, "file_name").distinct()
    firsts = files.groupBy("run_id", "doc_id").agg(F.min("doc_index").alias("doc_index"))
    copies = files.join(firsts, FILE_KEYS, "left_anti").select(*FILE_KEYS)
    return sections.join(copies, FILE_KEYS, "left_anti"), files


def for_every_file(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Results by content, once for each file that has it."""
    return files.join(rows.drop("doc_index", "file_name"), ["run_id", "doc_id"])


def dense_index(df: DataFrame, key: str, output: str, start: int = 1, tie: list[str] | None = None) -> DataFrame:
    """Consecutive numbers in order of ``key`` and the ``tie`` columns, nulls first.

    Only the ordering columns are dealt into ranges and numbered there; a range's numbers are
    shifted by the sizes of the ranges before it, and the number is joined back. Rows equal in
    all ordering columns share a range's place and are told apart last. The checkpoint fixes
    the ranges, so that all readers see the same ones.
    """
    order = [key, *(tie or [])]
    counted = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    ranged = cut_lineage(counted.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.sum("_n").alias("_rows"))  # as many rows as there are partitions
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(shifts), "_range").select(
        *[F.col(c).alias(f"_k_{i}") for i, c in enumerate(order)], (F.col("_shift") + F.col("_before")).alias("_first"))
    joined = df.join(placed, reduce(lambda x, y: x & y, [df[c].eqNullSafe(F.col(f"_k_{i}")) for i, c in enumerate(order)]))
    copy = F.row_number().over(Window.partitionBy("_first").orderBy("_first"))
    return joined.withColumn(output, F.col("_first") + copy + F.lit(start - 1)).select(*df.columns, output)

"""Blocks: many documents in one stored row, with a dictionary of what occurs in them.

Corpus-wide facts about words or pairs reach the documents through the dictionaries: a block holds
every entry once, so an entry has one row per block however often it occurs, and no key can hold a
large share of the rows. Documents name entries by their place in the dictionary of their block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import give_back, shared_folder


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def starts(sizes: np.ndarray) -> np.ndarray:
    """Where each of the runs of these sizes begins, and at last where the last one ends."""
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64)


def gather(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``flat``, one after the other; run i has ``sizes[i]`` numbers."""
    taken = sizes[which]
    ends = np.cumsum(taken)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(starts(sizes)[which] - ends + taken, taken)]


def slices(text: str, size: int, is_space: Callable[[str], bool] = str.isspace) -> Iterator[str]:
    """The text in parts of about ``size`` characters that end before a white space."""
    low = 0
    while low < len(text):
        high = low + size
        while high < len(text) and not is_space(text[high]):
            high += 1
        yield text[low:high]
        low = high


def in_blocks(batches: Iterator[pa.RecordBatch], size: int, text: int = 1) -> Iterator[tuple[int, list[tuple]]]:
    """Rows in runs of about ``size`` characters of their text, each with a number of its own."""
    first = TaskContext.get().partitionId() << 32
    held, chars, block = [], 0, 0
    for batch in batches:
        for row in zip(*batch.columns):
            row = tuple(x.as_py() for x in row)
            held.append(row)
            chars += len(row[text]) + 16
            if chars >= size:
                yield first + block, held
                held, chars, block = [], 0, block + 1
    if held:
        yield first + block, held


def stored_by_block(cuts: DataFrame) -> DataFrame:
    """The blocks written to the shared folder in buckets of their number and read again, so that
    they need not be shuffled when values come back to them."""
    spark, name = cuts.sparkSession, f"llm_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_folder(spark)}/{name}"
    cuts.write.bucketBy(buckets, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    held = spark.table(name)
    held.schema  # resolved: from here on only the files count
    spark.sql(f"DROP TABLE {name}")
    return held


def entries(blocks: DataFrame, name: str, *others: str) -> DataFrame:
    """One row per entry of each block: block, at, the entry and the columns that run along with it."""
    along = F.arrays_zip(name, *others) if others else F.transform(name, lambda x: F.struct(x.alias(name)))
    return blocks.select("block", F.posexplode(along).alias("at", "entry")).select("block", "at", *[F.col(f"entry.{c}").alias(c) for c in (name, *others)])


def rebuilt(blocks: DataFrame, values: DataFrame, body: Callable[[dict, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``body(block, values)`` for each block, with the values of its entries in their order.

    ``values`` has block, at and more; every entry of the dictionary has one row. Blocks without
    entries get an empty table.
    """
    def of(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return body(left.to_pylist()[0], right.sort_by("at"))
        finally:
            give_back()

    own = values.withColumnRenamed("block", "of_block")  # both sides may come from the same rows
    return blocks.groupBy("block").cogroup(own.groupBy("of_block")).applyInArrow(of, schema)

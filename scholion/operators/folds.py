"""Ordered folds with a merge function of the user.

The records of a key are merged from left to right. Rows are dealt into ranges of key and order, so
a key with any share of the records is spread over several ranges; each range folds its stretch of a
key, and the results of neighbouring ranges are folded again until one is left. The function must be
associative, not commutative: the order is kept throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Results of ranges that one task folds for a key.
FAN_IN = 64
#: Folded records that leave a task at once.
SENT = 1_000

Merge = Callable[[dict, dict], dict]


def ordered_fold(rows: DataFrame, keys: list[str], order: str, value: str, merge: Merge, ranges: int | None = None) -> DataFrame:
    """One row per key: the keys, ``n`` (records) and ``value``, all its records merged in order.

    ``value`` is a struct column whose records reach ``merge`` as dicts; null records are left out.
    ``order`` may be a struct; equal places keep no order among each other.
    """
    spark = rows.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = rows.where(F.col(value).isNotNull()).select(*keys, F.col(order).alias("_at"), F.lit(1).cast("long").alias("n"), value)
    schema = part.schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        shape, held, last = to_arrow_schema(schema), [], None
        for batch in batches:
            for row in batch.to_pylist():
                if last is not None and all(last[k] == row[k] for k in keys):
                    last = last | {"n": last["n"] + row["n"], value: merge(last[value], row[value])}
                    continue
                if last is not None:
                    held.append(last)
                last = row
                if len(held) >= SENT:
                    yield pa.RecordBatch.from_pylist(held, shape)
                    held = []
        if last is not None:
            yield pa.RecordBatch.from_pylist([*held, last], shape)

    def folded(df: DataFrame, *dealt: str, into: int) -> DataFrame:
        spread = df.repartition(into, *dealt) if dealt == tuple(keys) else df.repartitionByRange(into, *dealt)
        return spread.sortWithinPartitions(*keys, "_at").mapInArrow(fold, schema)

    part = folded(part, *keys, "_at", into=n)
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        part = folded(part, *keys, "_at", into=n)
    # each range has at most one result per key, so a key has no more of them than there are ranges
    return folded(part, *keys, into=ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))).drop("_at")

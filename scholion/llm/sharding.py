"""Shards by jump consistent hashing, as DataFrame expressions.

A key's shard depends on the key and the number of shards alone. The generator is the 64-bit
congruential one of the published algorithm; products are taken in 38-digit decimals, which
hold them exactly, so that nothing overflows.

Defined cases: a null key is a key of its own; a null text has size 1 and the checksum of the
empty text; repeated rows go to one shard and get slots of their own; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholion.llm.common import stored, unused

MULTIPLIER = 2862933555777941757
MODULUS = 2**64
#: Steps that are always run; a key that needs more gets them in a second round.
FIRST_STEPS = 32
NULL_KEY = "\x00null"
#: Cells per shard that are numbered apart, and copies of one row that are written out together.
CELLS, BLOCK = 1024, 1000


def _number(value: int, digits: int = 20) -> Column:
    return F.lit(str(value)).cast(f"decimal({digits},0)")


def _hex_number(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("decimal(20,0)")


def stable_key(key: Column) -> Column:
    """Unsigned 64-bit number of any key: the first half of the md5 of its text."""
    return _hex_number(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(NULL_KEY)).cast("binary")), 1, 16))


def _advance(state: Column, shards: int) -> Column:
    key = ((state["key"] * _number(MULTIPLIER) + _number(1)) % _number(MODULUS)).cast("decimal(20,0)")
    draw = F.floor(key / _number(2**33, 10)).cast("long")
    reach = F.floor((state["jump"] + 1) * (F.lit(float(2**31)) / (draw + 1).cast("double"))).cast("long")
    moved = F.struct(state["jump"].alias("shard"), reach.alias("jump"), key.alias("key"))
    return F.when(state["jump"] < shards, moved).otherwise(state)


def jump_shard(number: Column, shards: int) -> Column:
    """Shard of an unsigned 64-bit number by the jump algorithm, 0 to ``shards`` - 1."""
    start = F.struct(F.lit(-1).cast("long").alias("shard"), F.lit(0).cast("long").alias("jump"), number.alias("key"))

    def run(state: Column, steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), state, lambda s, _: _advance(s, shards))

    first = run(start, min(shards, FIRST_STEPS))
    if shards > FIRST_STEPS:  # each step moves on by one at least
        first = F.transform(F.array(first), lambda s: F.when(s["jump"] < shards, run(s, shards - FIRST_STEPS)).otherwise(s))[0]
    return first["shard"].cast("int")


def assign(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """All rows and columns, with ``shard`` and ``grown_shard`` (one shard more) appended.

    A column that has one of these names keeps it, and the new one gets ``_`` at its end.
    """
    number = stable_key(F.col(key))
    return docs.withColumns({unused(docs, "shard"): jump_shard(number, shards), unused(docs, "grown_shard"): jump_shard(number, shards + 1)})


def place(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard.

    Slots number each shard from 0 without gaps. Equal rows are counted before they are numbered
    and written out again in blocks, and a shard is numbered in ``CELLS`` cells at once, so
    neither a frequent key nor a whole shard meets in one task. The table of cells has
    shards x CELLS rows at most, which bounds what is broadcast.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    counted = (docs.select(F.col(key), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"))
               .groupBy(key, "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies")))
    mark = F.md5(F.concat_ws(",", F.coalesce(F.col(key).cast("string"), F.lit(NULL_KEY)), "size", "text_crc32").cast("binary"))
    placed = stored(assign(counted, shards, key).withColumn("cell", (F.conv(F.substring(mark, 1, 8), 16, 10).cast("long") % CELLS).cast("int")))
    totals = placed.groupBy("shard", "cell").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    earlier = (Window.partitionBy("shard", "cell").orderBy(F.col(key).asc_nulls_first(), "size", "text_crc32")
               .rowsBetween(Window.unboundedPreceding, -1))
    first = placed.join(F.broadcast(offsets), ["shard", "cell"]).withColumn(
        "first", F.col("offset") + F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    blocks = first.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / BLOCK).cast("long"))))
    spread = blocks.hint("rebalance")
    place_in_block = F.explode(F.sequence(F.col("block") * BLOCK, F.least((F.col("block") + 1) * BLOCK, F.col("copies")) - 1))
    return (spread.withColumn("at", place_in_block)
            .select(key, "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("first") + F.col("at")).alias("slot"), "grown_shard"))

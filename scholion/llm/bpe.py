"""Byte-level BPE encoding and decoding by overlapping chunks.

Long texts are cut into chunks that overlap. Each chunk is pre-tokenised on its own, as a row of
its own, and its pre-tokens are encoded. A pre-token depends only on where it starts and on what
follows, so from the first start that two neighbours share they agree: there they are stitched.
If they share none in the overlap, the text is pre-tokenised again from the last sure start until
they do. Texts of one chunk stay in their row and are never shuffled. Decoding joins the bytes of
the ids.

Defined cases: null texts count as empty and have no ids; equal long texts are encoded once;
repeated rows each get their result; columns other than key and text are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.llm.common import text_key

#: Characters of a chunk and of the overlap with its neighbours.
CHUNK, OVERLAP = 32_768, 256
#: Pre-tokens whose ids a worker remembers; bytes of ids in one batch that it returns.
REMEMBERED, BATCH_BYTES = 100_000, 4_000_000
#: Rows that are decoded at once.
DECODED_ROWS = 200


class Vocabulary:
    """Ranks of byte strings, with the ids of recent pre-tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pre_tokens = regex.compile(pattern).findall
        self._piece = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        pieces = dict(map(reversed, ranks.items()))
        self._lengths = np.array([len(pieces.get(i, b"")) for i in range(max(pieces) + 1)], dtype=np.int64)
        self._starts = np.concatenate([[0], np.cumsum(self._lengths)[:-1]])
        self._bytes = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(max(pieces) + 1)), dtype=np.uint8)
        self._known: dict[str, bytes] = {}

    def ids(self, pre_tokens: list[str]) -> list[bytes]:
        """For each pre-token its ids as little-endian 32-bit numbers."""
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        for p in set(pre_tokens).difference(known):
            known[p] = np.array(self._piece(p.encode("utf-8", "surrogatepass")), dtype="<u4").tobytes()
        return [known[p] for p in pre_tokens]

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, dtype="<u4")
        lengths = self._lengths[numbers]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        return self._bytes[np.arange(ends[-1]) + np.repeat(self._starts[numbers] - ends + lengths, lengths)].tobytes()


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One vocabulary per Python worker."""
    return Vocabulary(path, pattern)


class Run:
    """Pre-tokens of a stretch of text: their starts, and their ids one after the other."""

    def __init__(self, text: str, start: int, lengths: np.ndarray, sizes: np.ndarray, ids: bytes):
        self.text, self.start, self.lengths, self.sizes, self.ids = text, start, lengths, sizes, ids
        self.starts = start + np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)[:-1]
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)

    @classmethod
    def of(cls, words: Vocabulary, text: str, start: int) -> Run:
        found = words.pre_tokens(text)
        ids = words.ids(found)
        return cls(text, start, np.fromiter(map(len, found), np.int64, len(found)),
                   np.fromiter(map(len, ids), np.int64, len(ids)), b"".join(ids))

    def part(self, low: int, high: int | None = None) -> bytes:
        """Ids of the pre-tokens that start from ``low`` and before ``high``."""
        a = np.searchsorted(self.starts, low)
        b = len(self.starts) if high is None else np.searchsorted(self.starts, high)
        return self.ids[self.offsets[a]:self.offsets[max(a, b)]]


def stitch(words: Vocabulary, runs: list[Run]) -> bytes:
    """Ids of the whole text from the runs of its overlapping chunks, in order.

    The last pre-token of a run that isn't the last may be cut, but its start is sure.
    """
    done: list[bytes] = []
    current, sure = runs[0], 0
    for after in runs[1:]:
        shared = np.intersect1d(current.starts[current.starts >= max(sure, after.start)], after.starts, assume_unique=True)
        if not len(shared):  # a pre-token covers the overlap: go on from its start
            last = int(current.starts[-1])
            done.append(current.part(sure, last))
            ahead = current.text[last - current.start:] + after.text[current.start + len(current.text) - after.start:]
            longer = Run.of(words, ahead, last)
            shared = np.intersect1d(longer.starts[longer.starts > last], after.starts, assume_unique=True)
            current, sure = longer, last
            if not len(shared):
                continue
        meet = int(shared[0])
        done.append(current.part(sure, meet))
        current, sure = after, meet
    done.append(current.part(sure))
    return b"".join(done)


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches of rows; the last column of a row is bytes and bounds the batch."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1]) + 64
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def encode(docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: key, n_tokens, ids (little-endian 32-bit numbers)."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = F.char_length("text") > chunk
    key_type = rows.schema["key"].dataType.simpleString()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in batches:
            def rows() -> Iterator[tuple]:
                for k, x in zip(batch.column(0), batch.column(1)):
                    ids = Run.of(words, x.as_py(), 0).ids
                    yield k.as_py(), len(ids) // 4, ids
            yield from _batches(rows(), ["key", "n_tokens", "ids"], [batch.schema.field(0).type, pa.int64(), pa.binary()])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for batch in batches:
            def rows() -> Iterator[tuple]:
                for uid, start, x in zip(*(c.to_pylist() for c in batch.columns)):
                    run = Run.of(words, x, start)
                    yield uid, start, x, run.lengths.astype("<u4").tobytes(), (run.sizes // 4).astype("<u4").tobytes(), run.ids
            yield from _batches(rows(), ["uid", "start", "text", "lengths", "sizes", "ids"],
                                [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()])

    def joined(table: pa.Table) -> pa.Table:
        words = vocabulary(ranks, pattern)
        of = sorted(table.to_pylist(), key=lambda r: r["start"])
        ids = stitch(words, [Run(r["text"], r["start"], np.frombuffer(r["lengths"], "<u4").astype(np.int64),
                                 np.frombuffer(r["sizes"], "<u4").astype(np.int64) * 4, r["ids"]) for r in of])
        return pa.table({"uid": [of[0]["uid"]], "n_tokens": [len(ids) // 4], "ids": pa.array([ids], pa.binary())})

    short = rows.where(~long).mapInArrow(whole, f"key {key_type}, n_tokens long, ids binary")
    large = rows.where(long).withColumn("uid", text_key(F.col("text")))
    starts = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / chunk).cast("int"))
    cut = large.select("uid", "text", F.explode(starts).alias("i")).select(
        "uid", F.greatest(F.col("i") * chunk - overlap, F.lit(0)).cast("long").alias("start"), "text", "i").select(
        "uid", "start", F.substring("text", F.col("start").cast("int") + 1, (F.col("i") + 1) * chunk + overlap - F.col("start").cast("int")).alias("text"))
    encoded = cut.dropDuplicates(["uid", "start"]).mapInArrow(
        pieces, "uid string, start long, text string, lengths binary, sizes binary, ids binary")
    stitched = encoded.groupBy("uid").applyInArrow(joined, "uid string, n_tokens long, ids binary")
    return short.unionByName(large.select("key", "uid").join(stitched, "uid").select("key", "n_tokens", "ids")).withColumnRenamed("key", key)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``, the bytes that their ids stand for; null ids stay null."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks, pattern)
        for whole in batches:
            for low in range(0, whole.num_rows, DECODED_ROWS):
                batch = whole.slice(low, DECODED_ROWS)
                column = batch.column(batch.schema.get_field_index(ids))
                decoded = [words.decode(x.as_py()) if x.is_valid else None for x in column]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(bytes_of, schema)

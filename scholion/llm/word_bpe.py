"""BPE encoding and decoding through a table of distinct words.

Texts are split at white space, which a tokenizer that drops white space never crosses: normal
forms, special strings and pre-tokens all stay within. Plain Latin words are also split into
pre-tokens and made small, so that marks and capitals don't multiply the distinct words. The words of
a block of documents meet in the partition of the word, sorted, so that each distinct word of the
corpus is encoded once; its ids come back to the documents by position. Decoding joins the ids with
the table of pieces.

Defined cases: null texts count as empty, have no ids and decode to the empty text; repeated rows
each get their result; columns other than key and text are ignored; an id without a piece decodes
to nothing.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.llm import blocks
from scholion.llm.common import tidy

#: Characters of the texts in a block, and of a part of a long text that is split at once.
BLOCK, PART = 12_000_000, 1_000_000
#: Words of these signs alone are split further: no normal form, no case and no class of theirs is in doubt.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ‐-‧]*")
_PRE_TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-`{-~‐-‧]+")
#: White space of ``str.split`` that the tokenizer takes for signs.
SIGNS = "\x1c\x1d\x1e\x1f"
#: Words that leave a block at once; encoded words that a task holds before they are packed by block.
ROWS, PACKED = 50_000, 200_000
#: Documents that are decoded at once.
DECODED = 100


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """One tokenizer per Python worker, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


def words(text: str) -> Iterator[str]:
    """The runs of a text between white space, part by part."""
    for part in blocks.slices(text, PART, lambda c: c.isspace() and c not in SIGNS):
        if any(c in part for c in SIGNS):
            for sign in SIGNS:  # stand-ins that no text holds: surrogates
                part = part.replace(sign, chr(0xD800 + ord(sign)))
            for word in part.split():
                yield "".join(chr(ord(c) - 0xD800) if 0xD81C <= ord(c) <= 0xD81F else c for c in word)
        else:
            yield from part.split()


def parts(word: str) -> list[str]:
    """A word cut where its pre-tokens begin, if it is plain; the parts encode like the word."""
    if "<|" in word or not _PLAIN.fullmatch(word):
        return [word]
    return _PRE_TOKENS.findall(word.lower())


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """Blocks of documents: block, keys, sizes (words of each), codes, words (the dictionary)."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks.in_blocks(batches, size):
            whole, codes = _Codes(), _Codes()
            of = [np.fromiter(map(whole.__getitem__, words(x)), np.uint32) for _, x in held]
            cuts = [[codes[p] for p in parts(w)] for w in whole]
            n = np.array(list(map(len, cuts)), np.int64)
            flat = np.fromiter((c for x in cuts for c in x), np.int64)
            sizes = [int(n[x].sum()) for x in of]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([[k for k, _ in held]], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([blocks.pack(blocks.gather(flat, n, np.concatenate(of)))], pa.binary()), pa.array([_packed(list(codes))], pa.binary())],
                ["block", "keys", "sizes", "codes", "words"])

    kind = arrow_type(rows, "key")
    return rows.mapInArrow(tidy(pieces), f"block long, keys array<{key_type}>, sizes array<long>, codes binary, words binary")


def _packed(words: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress("\n".join(words).encode("utf-8", "surrogatepass"))


def entries(cuts: DataFrame) -> DataFrame:
    """block, at, word: the words of the blocks' dictionaries."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(*batch.columns):
                text = zstandard.ZstdDecompressor().decompress(packed.as_py()).decode("utf-8", "surrogatepass")
                held = text.split("\n") if text else []
                for low in range(0, len(held), ROWS):
                    some = held[low:low + ROWS]
                    yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(some), pa.int64()), pa.array(range(low, low + len(some)), pa.int32()),
                                                      pa.array(some, pa.string())], ["block", "at", "word"])

    return cuts.select("block", "words").mapInArrow(each, "block long, at int, word string")


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary as a table: id, piece. Its size is that of the tokenizer's file."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocabulary = dict(file["model"]["vocab"]) | {t["content"]: t["id"] for t in file["added_tokens"]}
    rows = pa.table({"id": pa.array(list(vocabulary.values()), pa.int32()), "piece": list(vocabulary)})
    return spark.createDataFrame(rows)


def encode_words(found: DataFrame, path: str) -> DataFrame:
    """block, at, places, sizes, ids (packed numbers) for rows of block, at, word: all rows of a word
    lie side by side, and the word is encoded once. A block's words come in several rows, each of
    which holds the places of its words in the dictionary and their ids; ``at`` is the first place."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_of = getattr(tokenizer(path), "encode_batch_fast", tokenizer(path).encode_batch)
        last, last_ids, held, n = None, b"", {}, 0
        for batch in batches:
            column = batch.column(2).dictionary_encode()
            distinct = column.dictionary.to_pylist()
            fresh = [w for w in distinct if w != last]
            ids = dict(zip(fresh, (np.array(e.ids, "<u4").tobytes() for e in batch_of(fresh, add_special_tokens=False))))
            of = [last_ids if w == last else ids[w] for w in distinct]
            if of:
                last = batch.column(2)[-1].as_py()
                last_ids = ids.get(last, last_ids)
            for block, at, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), column.indices.to_pylist()):
                places, words = held.setdefault(block, ([], []))
                places.append(at)
                words.append(of[code])
            n += batch.num_rows
            if n >= PACKED:
                yield _by_block(held)
                held, n = {}, 0
        if held:
            yield _by_block(held)

    together = found.repartition("word").sortWithinPartitions("word").select("block", "at", "word")
    return together.mapInArrow(tidy(each), "block long, at int, places binary, sizes binary, ids binary")


def _by_block(held: dict[int, tuple[list[int], list[bytes]]]) -> pa.RecordBatch:
    rows = [(block, min(places), blocks.pack(np.array(places)), blocks.pack(np.array(list(map(len, words))) // 4), blocks.pack(np.frombuffer(b"".join(words), "<u4")))
            for block, (places, words) in held.items()]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["block", "at", "places", "sizes", "ids"])


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = BLOCK, decoded: bool = False) -> DataFrame:
    """One row per document: key, n_tokens, ids (little-endian 32-bit numbers). With ``decoded`` also
    that column of ``decode``, made where the ids of a block are put together: no second Python
    worker has to hold them.
    """
    cuts = blocks.stored_by_block(cut(docs, key, text, size))
    kind = arrow_type(docs, key)

    def whole(block: dict, of: pa.Table) -> pa.Table:
        codes, sizes = blocks.unpack(block["codes"]), np.array(block["sizes"], dtype=np.int64)
        places, of_word, flat = (np.concatenate([np.zeros(0, np.int64), *map(blocks.unpack, of[name].to_pylist())]) for name in ("places", "sizes", "ids"))
        order = np.argsort(places)
        lengths = of_word[order]
        ids = blocks.gather(blocks.gather(flat, of_word, order), lengths, codes).astype("<u4")
        n = np.diff(blocks.starts(lengths[codes])[blocks.starts(sizes)])
        ends = blocks.starts(n)
        own = pa.table({"key": pa.array(block["keys"], kind), "n_tokens": pa.array(n),
                        "ids": pa.array([ids[low:high].tobytes() for low, high in zip(ends, ends[1:])], pa.binary())})
        return pa.Table.from_batches(_decoded(own.to_batches(), path, "ids")) if decoded else own

    key_type = docs.schema[key].dataType.simpleString()
    found = encode_words(entries(cuts), path)
    schema = f"key {key_type}, n_tokens long, ids binary{', decoded string' if decoded else ''}"
    return blocks.rebuilt(cuts.drop("words"), found, whole, schema).withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """The rows with ``decoded``: the ids joined with the vocabulary's table of pieces, whose texts a
    tokenizer without a decoder puts between spaces. Null ids stay null.

    The table is as large as the vocabulary at any size of the corpus, so each task holds it and
    joins by the place of the id; a row per id would be shuffled twice to come back in order.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    return encoded.mapInArrow(lambda batches: _decoded(batches, path, ids), schema)


def _decoded(batches: Iterable[pa.RecordBatch], path: str, ids: str) -> Iterator[pa.RecordBatch]:
    table = pieces(path)
    known = table.is_valid().to_numpy(zero_copy_only=False)
    for batch in (whole.slice(low, DECODED) for whole in batches for low in range(0, whole.num_rows, DECODED)):
        column = batch.column(batch.schema.get_field_index(ids))
        numbers = [np.frombuffer(x.as_py() or b"", "<u4").astype(np.int64) for x in column]
        numbers = [x[known[np.minimum(x, len(known) - 1)] & (x < len(known))] for x in numbers]
        joined = table.take(pa.array(np.concatenate(numbers) if numbers else np.zeros(0, np.int64)))
        starts = blocks.starts(np.array(list(map(len, numbers)), np.int64))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), joined), " ")
        yield pa.RecordBatch.from_arrays([*batch.columns, pc.if_else(column.is_valid(), texts, None)], [*batch.schema.names, "decoded"])


@lru_cache(maxsize=4)
def pieces(path: str) -> pa.Array:
    """The pieces of the vocabulary at the places of their ids; ids between that have none are empty."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    found = {i: piece for piece, i in file["model"]["vocab"].items()} | {t["id"]: t["content"] for t in file["added_tokens"]}
    return pa.array([found.get(i) for i in range(max(found) + 1)], pa.string())

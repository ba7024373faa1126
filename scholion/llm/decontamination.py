"""Benchmark passages in training documents, by a positional inverted index.

The index is partitioned by document: a segment holds, for each term, the sorted positions of its
tokens in the segment's documents, laid end to end with a gap between them. Segments are built
where the documents lie and written to the shared folder; nothing is shuffled. Only terms that the
test set has are stored, as no other token can take part in a match. A window of a test item is
looked up from its rarest term on: that term's positions, moved by its offset, are the possible
starts, and each further term, in order of its count over all documents, strikes out starts.
With ``slack`` a term may lie so many words beside its place (a proximity match).

The test set is taken in blocks of a bounded number of windows, each against all documents.

Defined cases: null or wordless texts have no words and no hits; items without an id or without
words are left out; rows that repeat an id are one item with all their windows; repeated documents
each get their result; empty tables give no rows or no hits; other columns are ignored by ``scan``
and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import stored, unused

WIDTH = 10
#: Pairs of item and window in a block; a block's terms and windows are sent to all tasks.
BLOCK = 200_000
#: Bytes of text in a segment, about.
SEGMENT_BYTES = 4 << 20
WORD_CHARACTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_UPPER = "".join(map(chr, range(65, 91)))


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lowered, runs of digits, letters and everything beyond ASCII."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD_CHARACTERS), 0)


def windows_of(items: DataFrame, width: int, item: str, text: str) -> DataFrame:
    """Distinct (item, words) of the windows; an item of fewer words is one window."""
    found = items.where(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    return found.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("words")).distinct()


class Windows:
    """A block of windows as arrays: terms by number, windows padded with -1, and whose they are."""

    def __init__(self, pairs: list[tuple[str, list[str]]], width: int):
        self.width = width
        distinct = {tuple(w): None for _, w in pairs}
        number = {w: i for i, w in enumerate(sorted(distinct))}
        self.terms = {t: i for i, t in enumerate(sorted({t for w in number for t in w}))}
        self.items = sorted({i for i, _ in pairs})
        item_number = {x: i for i, x in enumerate(self.items)}
        self.words = np.full((len(number), width), -1, dtype=np.int32)
        for w, i in number.items():
            self.words[i, :len(w)] = [self.terms[t] for t in w]
        self.lengths = (self.words >= 0).sum(axis=1).astype(np.int32)
        owners: list[list[int]] = [[] for _ in number]
        for item, w in pairs:
            owners[number[tuple(w)]].append(item_number[item])
        self.owners = [np.array(sorted(set(o)), dtype=np.int32) for o in owners]
        self.order = np.argsort(self.words, axis=1)

    def rarest_first(self, counts: np.ndarray) -> None:
        """Take each window's terms from now on in the order of these counts."""
        places = np.where(self.words >= 0, counts[self.words], np.iinfo(np.int64).max)
        self.order = np.argsort(places, axis=1, kind="stable")


class Segment:
    """Postings of some documents: positions by term, and where each document lies."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray, positions: np.ndarray):
        self.starts = starts
        self.keys = (np.repeat(terms.astype(np.int64), counts) << 32) | positions
        self.first = {"terms": terms, "bounds": np.concatenate([[0], np.cumsum(counts)])}

    def matches(self, windows: Windows, slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of all matches; starts are positions in the segment."""
        terms, bounds = self.first["terms"], self.first["bounds"]
        rarest = windows.words[np.arange(len(windows.words)), windows.order[:, 0]]
        at = np.searchsorted(terms, rarest)
        there = np.flatnonzero((at < len(terms)) & (terms[np.minimum(at, max(0, len(terms) - 1))] == rarest)) if len(terms) else np.zeros(0, int)
        low, number = bounds[at[there]], np.diff(bounds)[at[there]]
        window = np.repeat(there, number)
        within = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        start = (self.keys[np.repeat(low, number) + within] & 0xFFFFFFFF) - windows.order[window, 0]
        for rank in range(1, windows.width):
            place = windows.order[window, rank]
            term = windows.words[window, place].astype(np.int64)
            asked = rank < windows.lengths[window]
            nearest = np.searchsorted(self.keys, (term << 32) | np.maximum(start + place - slack, 0))
            hit = self.keys[np.minimum(nearest, len(self.keys) - 1)] if len(self.keys) else nearest
            kept = ~asked | ((nearest < len(self.keys)) & (hit >> 32 == term) & ((hit & 0xFFFFFFFF) <= start + place + slack))
            window, start = window[kept], start[kept]
        return window, start


def build_index(rows: DataFrame, windows: Windows, gap: int) -> DataFrame:
    """Segments of ``rows`` (row, key, text), written out: rows, keys, n_words, starts and postings."""
    session = rows.sparkSession
    shared = session.sparkContext.broadcast({t.encode(): i for t, i in windows.terms.items()})
    kind = rows.schema["key"].dataType.simpleString()
    names = ["rows", "keys", "n_words", "starts", "terms", "counts", "positions"]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get

        def segment(held: list, key_type: pa.DataType) -> pa.RecordBatch:
            sizes = np.array([len(t) for _, _, t in held], dtype=np.int64)
            starts = np.cumsum(sizes + gap) - sizes - gap
            tokens = np.concatenate([t for _, _, t in held])
            place = np.arange(len(tokens)) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
            known = np.flatnonzero(tokens >= 0)
            by_term = known[np.argsort(tokens[known], kind="stable")]
            terms, counts = np.unique(tokens[known], return_counts=True)
            values = [[r for r, _, _ in held], [k for _, k, _ in held], sizes, starts, terms, counts, place[by_term]]
            types = [pa.int64(), key_type, pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.list_(t)) for v, t in zip(values, types)], names)

        held, size = [], 0
        for batch in batches:
            key_type = batch.schema.field(1).type
            for r, k, x in zip(*batch.columns):
                data = (x.as_py() or "").encode("utf-8", "replace").translate(_FOLDED).split()
                held.append((r.as_py(), k.as_py(), np.fromiter(map(number, data, repeat(-1)), np.int32, len(data))))
                size += 6 * len(data) + 64
                if size > SEGMENT_BYTES:
                    yield segment(held, key_type)
                    held, size = [], 0
        if held:
            yield segment(held, key_type)

    schema = (f"rows array<bigint>, keys array<{kind}>, n_words array<bigint>, starts array<bigint>, "
              "terms array<int>, counts array<int>, positions array<int>")
    return stored(rows.mapInArrow(segments, schema))


def _numbers(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def search(index: DataFrame, windows: Windows, kind: str, slack: int = 0) -> DataFrame:
    """One row per document of the index: row, key, n_words, hits (places of words), items."""
    counts = np.zeros(len(windows.terms), dtype=np.int64)
    seen = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("n"))
    for r in seen.collect():  # as many rows as the block has terms
        counts[r["terms"]] = r["n"]
    windows.rarest_first(counts)
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                starts, sizes = _numbers(column["starts"], i), _numbers(column["n_words"], i)
                part = Segment(starts, _numbers(column["terms"], i), _numbers(column["counts"], i), _numbers(column["positions"], i).astype(np.int64))
                window, start = part.matches(own, slack)
                doc = np.searchsorted(starts, start + own.order[window, 0], side="right") - 1
                hits: list[list[int]] = [[] for _ in starts]
                items: list[list[str]] = [[] for _ in starts]
                for d in np.unique(doc):
                    of = doc == d
                    span = (start[of] - starts[d])[:, None] + np.arange(own.width)[None, :]
                    covered = span[np.arange(own.width)[None, :] < own.lengths[window[of]][:, None]]
                    hits[d] = np.unique(covered[(covered >= 0) & (covered < sizes[d])]).tolist()
                    items[d] = [own.items[k] for k in np.unique(np.concatenate([own.owners[w] for w in np.unique(window[of])]))]
                yield pa.RecordBatch.from_arrays(
                    [column["rows"][i].values, column["keys"][i].values, column["n_words"][i].values,
                     pa.array(hits, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))], ["row", "key", "n_words", "hits", "items"])

    return index.mapInArrow(found, f"row bigint, key {kind}, n_words bigint, hits array<int>, items array<string>")


def scan(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         width: int = WIDTH, slack: int = 0, block: int = BLOCK) -> DataFrame:
    """One row per document: key, n_words, hits (places of hit words, from 0), items (their ids as text, sorted)."""
    windows = stored(windows_of(items, width, item, item_text))
    blocks = -(-windows.count() // block)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    if blocks > 1:
        rows = stored(rows)  # so that a row keeps its number in all blocks
    results = None
    for b in range(max(1, blocks)):
        part = windows.where(F.pmod(F.xxhash64("item", "words"), F.lit(max(1, blocks))) == b)
        own = Windows([(r["item"], r["words"]) for r in part.collect()], width)
        result = search(build_index(rows, own, width + slack), own, kind, slack)
        results = result if results is None else results.unionByName(result)
    if blocks > 1:  # as many rows of a document as there are blocks
        results = results.groupBy("row").agg(
            F.first("key").alias("key"), F.first("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    return results.select(F.col("key").alias(key), "n_words", "hits", F.array_sort("items").alias("items"))


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items_sha256, contaminated."""
    return found.select(key, "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The documents, with all their columns, in which no window of an item occurs.

    The documents are written out with a number for each row; the rows of the (few) hit documents
    are taken out by that number.
    """
    number = unused(docs, "__row")
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()))
    hit = scan(rows.select(number, text), items, key=number, text=text).where(F.size("hits") > 0).select(number)
    return rows.join(hit, number, "left_anti").select(*docs.columns)

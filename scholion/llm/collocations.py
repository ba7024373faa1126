"""Phrase collocations: counts of all frequent phrases by HAT-tries, and the phrases that hold together.

Texts become blocks of word numbers once. Then each length is counted in turn. First the occurrences
are added up by a hash of their phrase: a phrase whose hash occurs too rarely in the corpus can't be
frequent, and a bitmap of fixed size tells tasks which hashes do. Then a task feeds the phrases that
are left to a HAT-trie, whose upper levels branch by word id and whose leaves are hash containers
that burst into a branch when they grow too large. When the trie is full, whole subtrees leave it as
sorted runs; Spark brings the runs of a prefix into one partition and adds them up. A phrase can be
frequent only if both its parts without the last and without the first word are, so a second bitmap
leaves out the extensions of others. The maps only err towards counting; the exact sums decide. The
blocks are written again without the words that are too rare for any phrase.

Defined cases: a null language counts as ``und``, null texts as empty; repeated rows count as often
as they occur; texts without words give none; columns other than text and language are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm import blocks
from scholion.llm.common import small_batches, stored, tidy

LONGEST, MIN_COUNT, TOP, SCALE, SHARE = 5, 100, 2000, 1000, 100
#: Characters of the texts in a block, and bytes of a long text that is split at once.
BLOCK, PART = 4_000_000, 1 << 20
#: Entries of a container before it bursts, of a trie before it spills; words that a task numbers at most.
BURST, HELD, NAMED = 4_096, 300_000, 200_000
#: Rows of runs that leave a task at once.
SENT = 50_000
#: Bits of the maps of phrases: 8 MB at any size of the corpus; bits of a chunk of a map.
FILTER_BITS, CHUNK_BITS = 26, 16
#: Hashes that a task holds before they are added up and leave it.
HASHED = 2_000_000
#: Documents, and blocks or rows of packed hashes, that come to a task at once.
AT_ONCE, BLOCKS_AT_ONCE = 500, 2
#: First words of a phrase whose runs meet in one partition.
PREFIX = 3
#: Parts into which a language's phrases are dealt to be ranked, and a frequent part's phrases to be joined.
RANK_PARTS, JOIN_PARTS = 64, 16

#: Letters become small, marks that end a piece one full stop, tabs spaces.
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9 + b" ")


# --- words of blocks

_END = re.compile(rb"[ .]")


def _parts(text: bytes) -> Iterator[bytes]:
    low = 0
    while low < len(text):
        end = _END.search(text, low + PART)
        high = end.start() if end else len(text)
        yield text[low:high]
        low = high


def tokens(text: str) -> Iterator[bytes]:
    """The words of a text in order, with ``.`` where a piece ends."""
    for part in _parts(text.encode("utf-8", "surrogatepass").translate(_PLAIN)):
        yield from part.replace(b".", b" . ").split()


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


BLOCKS = ["block", "langs", "n", "of", "words", "hashes", "codes"]


def cut(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = BLOCK) -> DataFrame:
    """Blocks: block, langs, n (words of each language), of (place of each word's language), words,
    hashes (of the words), codes (places of the words; 0 separates pieces, word w is w + 1)."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks.in_blocks(batches, size):
            langs, n, words, hashes, of, codes = [], [], [], [], [], []
            for name in sorted({x for x, _ in held}):
                before = hash_start(name)
                own = _Codes({b".": 0})
                mine = [np.fromiter(map(own.__getitem__, tokens(x)), np.int64) for x in (x for n, x in held if n == name)]
                mine = np.concatenate([y for x in mine for y in (x, [0])])
                codes.append(np.where(mine > 0, mine + len(words), 0))
                of += [len(langs)] * (len(own) - 1)
                words += [w.decode("utf-8", "surrogatepass") for w in own][1:]
                hashes += [xxhash.xxh64_intdigest(before + w) for w in own][1:]
                n.append(int(np.count_nonzero(mine)))
                langs.append(name)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([langs]), pa.array([n], pa.list_(pa.int64())), pa.array([of], pa.list_(pa.int32())),
                 pa.array([words], pa.list_(pa.string())), pa.array([np.array(hashes, np.uint64).tobytes()], pa.binary()),
                 pa.array([blocks.pack(np.concatenate(codes))], pa.binary())], BLOCKS)

    return rows.mapInArrow(tidy(pieces), "block long, langs array<string>, n array<long>, of array<int>, words array<string>, hashes binary, codes binary")


# --- the map of phrases that may be frequent

_ODD = np.uint64(0x9E3779B97F4A7C15)


def hash_start(lang: str) -> bytes:
    return f"{lang}\0".encode("utf-8", "surrogatepass")


def word_hash(lang: str, word: str) -> int:
    return xxhash.xxh64_intdigest(hash_start(lang) + word.encode("utf-8", "surrogatepass"))


def bits(hashes: np.ndarray) -> np.ndarray:
    """Bit of each row of word hashes (uint64, one column a word)."""
    with np.errstate(over="ignore"):
        mixed = np.zeros(len(hashes), np.uint64)
        for column in hashes.T:
            mixed = (mixed ^ column) * _ODD
            mixed ^= mixed >> np.uint64(29)
        return (mixed * _ODD) >> np.uint64(64 - FILTER_BITS)


def in_map(held: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bit of each row of word hashes is set in a map."""
    at = bits(hashes)
    return (held[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & np.uint8(1) == 1


def bitmap(frequent: DataFrame, length: int) -> bytes:
    """The map of the phrases of a table (lang, phrase): 2 ** FILTER_BITS bits, whatever their number."""
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hashes = [[word_hash(lang, w) for w in phrase.split(" ")] for lang, phrase in zip(batch["lang"], batch["phrase"])]
            yield pd.DataFrame({"bit": bits(np.array(hashes, np.uint64).reshape(-1, length)).astype(np.int64)})

    def chunk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for number, places in zip(batch["chunk"], batch["places"]):
                held = np.zeros(1 << 16, bool)
                held[places] = True
                yield pd.DataFrame({"chunk": [number], "map": [np.packbits(held).tobytes()]})

    found = frequent.select("lang", "phrase").mapInPandas(each, "bit long")
    chunks = found.groupBy((F.col("bit") / F.lit(1 << CHUNK_BITS)).cast("long").alias("chunk")).agg(
        F.collect_set((F.col("bit") % F.lit(1 << CHUNK_BITS)).cast("int")).alias("places")).mapInPandas(chunk, "chunk long, map binary")
    return _whole(chunks)


def _whole(chunks: DataFrame) -> bytes:
    """The map whose chunks (chunk, map) these are."""
    whole, size = bytearray(1 << (FILTER_BITS - 3)), 1 << (CHUNK_BITS - 3)
    for row in chunks.collect():  # the whole map is of fixed size
        whole[row["chunk"] * size:(row["chunk"] + 1) * size] = row["map"]
    return bytes(whole)


def hashed_often(cuts: DataFrame, length: int, least: int, before: bytes | None = None, hashed: int = HASHED) -> bytes:
    """The map of the hashes that ``least`` occurrences of phrases of a length have, or more.

    Tasks send how often each hash occurs, packed by chunk of the map; the chunk's sums are found in
    its partition, row by row.
    """
    shared = cuts.sparkSession.sparkContext.broadcast(before) if before else None

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held)
        held.clear()
        rows.sort()
        found, counts = (rows >> np.uint64(32)).astype(np.uint32), rows & np.uint64((1 << 32) - 1)
        heads = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        found, counts = found[heads], np.minimum(np.add.reduceat(counts, heads), np.uint64(least)).astype("<u4")
        chunks, first = np.unique(found >> np.uint32(CHUNK_BITS), return_index=True)
        ends = [*first[1:].tolist(), len(found)]
        low = (found & np.uint32((1 << CHUNK_BITS) - 1)).astype("<u2")
        rows = [(low[i:j], counts[i:j]) for i, j in zip(first.tolist(), ends)]
        # steps and counts are small, so that their high bytes, side by side, all but vanish in the shuffle
        planes = lambda x: np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()
        return pa.RecordBatch.from_arrays([pa.array(chunks.astype(np.int32)), pa.array([planes(np.diff(p, prepend=p.dtype.type(0))) for p, _ in rows], pa.binary()),
                                           pa.array([planes(c) for _, c in rows], pa.binary())], ["chunk", "places", "counts"])

    def hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(shared.value, np.uint8) if shared else None
        held, n = [], 0
        for rows in batches:
            for codes, own in zip(*rows.columns):
                codes, own = blocks.unpack(codes.as_py()), np.frombuffer(own.as_py(), np.uint64)
                if length == 1:
                    found, counts = bits(own[:, None]), np.bincount(codes, minlength=len(own) + 1)[1:]
                else:
                    at = _places(codes, own, length, frequent)
                    found = bits(own[np.stack([codes[at + i] for i in range(length)], axis=1) - 1])
                    counts = 1
                held.append(found << np.uint64(32) | np.asarray(counts, np.uint64))
                n += len(found)
                if n >= hashed:
                    yield packed(held)
                    n = 0
        if n:
            yield packed(held)

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([last], pa.int32()), pa.array([np.packbits(sums >= least).tobytes()], pa.binary())], ["chunk", "map"])
        flat = lambda x, kind: np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
        for rows in batches:
            for chunk, places, counts in zip(*(c.to_pylist() for c in rows.columns)):
                if chunk != last:
                    if last is not None:
                        yield done()
                    last, sums = chunk, np.zeros(1 << CHUNK_BITS, np.int64)
                sums[np.cumsum(flat(places, "<u2"), dtype=np.uint16)] += flat(counts, "<u4")
        if last is not None:
            yield done()

    sent = cuts.select("codes", "hashes").mapInArrow(tidy(hashes_of), "chunk int, places binary, counts binary")
    with small_batches(cuts.sparkSession, BLOCKS_AT_ONCE):
        return _whole(sent.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(tidy(often), "chunk int, map binary"))


# --- counting

class HatTrie:
    """Counts of rows of word ids (bytes, four a word, most significant first).

    A node is a dict from the next word to a node (a branch of the trie) or a ``Container``.
    """

    class Container(dict):
        """Hash table from the rest of a row to its count."""

    def __init__(self, words: int, burst: int = BURST):
        self.words, self.burst, self.root, self.size = words, burst, self.Container(), 0

    def add(self, row: bytes, count: int) -> None:
        above, node, at = None, self.root, 0
        while type(node) is dict:
            above, step = node, row[at:at + 4]
            node = node.get(step)
            if node is None:
                node = above[step] = self.Container()
            at += 4
        rest = row[at:]
        if rest in node:
            node[rest] += count
            return
        node[rest] = count
        self.size += 1
        if len(node) > self.burst and at < 4 * (self.words - 1):
            branch = self._branch(node)
            if above is None:
                self.root = branch
            else:
                above[row[at - 4:at]] = branch

    def _branch(self, container: Container) -> dict:
        branch: dict = {}
        for rest, count in container.items():
            branch.setdefault(rest[:4], self.Container())[rest[4:]] = count
        return branch

    def _rows(self, node, before: bytes) -> Iterator[tuple[bytes, int]]:
        if type(node) is dict:
            for step in sorted(node):
                yield from self._rows(node[step], before + step)
        else:
            for rest in sorted(node):
                yield before + rest, node[rest]

    def _weight(self, node) -> int:
        return sum(map(self._weight, node.values())) if type(node) is dict else len(node)

    def spill(self, keep: int = 0) -> Iterator[list[tuple[bytes, int]]]:
        """Sorted runs of whole subtrees, the heaviest first, until ``keep`` entries are left."""
        if type(self.root) is not dict and self.words > 1:
            self.root = self._branch(self.root)
        if type(self.root) is not dict or keep <= 0:
            yield list(self._rows(self.root, b""))
            self.root, self.size = self.Container(), 0
            return
        weights = {step: self._weight(node) for step, node in self.root.items()}
        for step in sorted(weights, key=lambda s: (-weights[s], s)):
            if self.size <= keep:
                return
            yield list(self._rows(self.root.pop(step), step))
            self.size -= weights[step]


def runs(cuts: DataFrame, length: int, before: bytes | None = None, often: bytes | None = None, held: int = HELD, burst: int = BURST, named: int = NAMED) -> DataFrame:
    """Sorted runs of the phrases of a length: lang, phrase, f. A phrase comes in several runs.

    ``before`` is the map of frequent phrases one word shorter; others' extensions are left out.
    ``often`` is that of the phrases whose hash occurs often enough; others are left out.
    """
    shared, shared_often = (cuts.sparkSession.sparkContext.broadcast(x) if x else None for x in (before, often))
    names = ["lang", "phrase", "f"]

    def batch(rows: list[tuple[bytes, int]], words: list[tuple[str, str]]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(r for r, _ in rows), ">u4").reshape(-1, length)
        text, lang = (pa.array([w[i] for w in words], pa.string()) for i in (1, 0))
        columns = [text.take(pa.array(c.astype(np.int64))) for c in ids.T]
        joined = columns[0] if length == 1 else pc.binary_join_element_wise(*columns, " ")
        return pa.RecordBatch.from_arrays([lang.take(pa.array(ids[:, 0].astype(np.int64))), joined, pa.array([c for _, c in rows], pa.int64())], names)

    def batches_of(spilled: Iterator[list[tuple[bytes, int]]], words: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, int]] = []
        for run in spilled:
            rows += run
            while len(rows) >= SENT:
                yield batch(rows[:SENT], words)
                rows = rows[SENT:]
        if rows:
            yield batch(rows, words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, likely = (np.frombuffer(x.value, np.uint8) if x else None for x in (shared, shared_often))
        trie, ids, words = HatTrie(length, burst), {}, []
        for rows in batches:
            for langs, of, own, hashes, codes in zip(*rows.columns):
                langs = langs.as_py()
                found, counts = _counted(blocks.unpack(codes.as_py()), np.frombuffer(hashes.as_py(), np.uint64), length, frequent, likely)
                used = np.unique(found)
                if len(ids) + len(used) > named and ids:
                    yield from batches_of(trie.spill(), words)
                    ids, words = {}, []
                to_id = np.zeros(len(own), np.int64)
                for i, k, w in zip(used.tolist(), of.values.take(pa.array(used)).to_pylist(), own.values.take(pa.array(used)).to_pylist()):
                    w = langs[k], w
                    if w not in ids:
                        ids[w] = len(words)
                        words.append(w)
                    to_id[i] = ids[w]
                wide = np.ascontiguousarray(to_id[found].astype(">u4"))
                for row, n in zip(wide.view(f"V{4 * length}").ravel().tolist(), counts.tolist()):
                    trie.add(row, n)
                    if trie.size > held:
                        yield from batches_of(trie.spill(held // 2), words)
        yield from batches_of(trie.spill(), words)

    return cuts.select("langs", "of", "words", "hashes", "codes").mapInArrow(tidy(count), "lang string, phrase string, f long")


def compacted(cuts: DataFrame, before: bytes) -> DataFrame:
    """The blocks without the words that the map of single words leaves out: pieces end there, as no
    frequent phrase holds them."""
    shared = cuts.sparkSession.sparkContext.broadcast(before)

    def smaller(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(shared.value, np.uint8)
        for rows in batches:
            for block, langs, n, of, words, hashes, codes in zip(*rows.columns):
                hashes = np.frombuffer(hashes.as_py(), np.uint64)
                stays = in_map(frequent, hashes[:, None])
                place = np.where(stays, np.cumsum(stays), 0)
                new = np.concatenate([[0], place])[blocks.unpack(codes.as_py())]
                new = new[(new > 0) | (np.concatenate([[0], new[:-1]]) > 0)]
                kept = pa.array(np.flatnonzero(stays))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.as_py()]), pa.array([langs.as_py()]), pa.array([n.as_py()], pa.list_(pa.int64())),
                     _one_list(of.values.take(kept)), _one_list(words.values.take(kept)),
                     pa.array([hashes[stays].tobytes()], pa.binary()), pa.array([blocks.pack(new)], pa.binary())], BLOCKS)

    return cuts.select(*BLOCKS).mapInArrow(tidy(smaller), cuts.schema)


def _one_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _places(codes: np.ndarray, hashes: np.ndarray, length: int, frequent: np.ndarray | None = None, likely: np.ndarray | None = None) -> np.ndarray:
    """Where the phrases of a block begin that the maps don't leave out."""
    n = len(codes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    good = np.ones(n, bool)
    for i in range(length):
        good &= codes[i:i + n] > 0
    at = np.flatnonzero(good)
    rows = lambda size, shift=0: hashes[np.stack([codes[at + shift + i] for i in range(size)], axis=1) - 1]
    if likely is not None:
        at = at[in_map(likely, rows(length))]
    if frequent is not None and length > 1:
        for shift in (0, 1):
            at = at[in_map(frequent, rows(length - 1, shift))]
    return at


def _counted(codes: np.ndarray, hashes: np.ndarray, length: int, frequent: np.ndarray | None = None, likely: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct phrases of a block as rows of word places, and how often each occurs."""
    at = _places(codes, hashes, length, frequent, likely)
    if not len(at):
        return np.zeros((0, length), np.int64), np.zeros(0, np.int64)
    ranks = codes[at] - 1
    for i in range(1, length):  # number the distinct phrases word by word, so that the numbers stay small
        _, ranks = np.unique(ranks * len(hashes) + codes[at + i] - 1, return_inverse=True)
    _, first, counts = np.unique(ranks, return_index=True, return_counts=True)
    return np.stack([codes[at[first] + i] - 1 for i in range(length)], axis=1), counts


def merged(found: DataFrame) -> DataFrame:
    """The runs added up, prefix by prefix: lang, phrase, f. The prefix is found anew on both sides
    of the shuffle, so that it doesn't travel along."""
    prefix = F.substring_index("phrase", " ", PREFIX)
    return found.repartition("lang", prefix).groupBy("lang", prefix.alias("prefix"), "phrase").agg(F.sum("f").alias("f")).drop("prefix")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT,
                     size: int = BLOCK, **limits: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of up to ``longest`` words with f >= min_count: lang, length, phrase, f; and the
    number of all words of each language: lang, n."""
    with small_batches(docs.sparkSession, AT_ONCE):
        cuts = stored(cut(docs, text, lang, size))
    totals = cuts.select(F.explode(F.arrays_zip("langs", "n")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.n").alias("n")).where("n > 0")
    known, before = None, None
    for length in range(1, longest + 1):
        counts = merged(runs(cuts, length, before, hashed_often(cuts, length, min_count, before), **limits))
        with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
            level = stored(counts.where(F.col("f") >= min_count).select("lang", F.lit(length).alias("length"), "phrase", "f"))
        known = level if known is None else known.unionByName(level)
        if length < longest:
            before = bitmap(level, length)
        if length == 1 and longest > 1:
            with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
                cuts = stored(compacted(cuts, before))
    return known, totals


# --- scores

def _part(first: Column, count: Column) -> Column:
    return F.array_join(F.slice("words", first, count), " ")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT,
                 top: int = TOP, scale: int = SCALE, share: int = SHARE, **limits: int) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    a is the phrase's count; of its cuts into l (count of the first part) and r (of the rest) the one
    with the lowest score floor(scale * a * n / (l * r)) counts, the earliest of equals. A phrase
    within a longer candidate that has at least ``share`` percent of its count is left out.
    """
    known, totals = frequent_phrases(docs, text, lang, longest, min_count, **limits)
    known = stored(known)
    candidates = known.where("length > 1").select("lang", "phrase", F.col("f").alias("a"), "length", F.split("phrase", " ").alias("words"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(JOIN_PARTS)).cast("int")
    parts = candidates.select("lang", "phrase", "a", salt.alias("salt"), "words", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", "salt", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.size("words")).alias("rest"))
    copies = known.select("lang", "phrase", "f", F.explode(F.sequence(F.lit(0), F.lit(JOIN_PARTS - 1))).alias("salt"))
    for part, name in (("first", "l"), ("rest", "r")):
        parts = parts.join(copies.select("lang", "salt", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", "salt", part]).drop(part)
    number = lambda c: F.col(c).cast("decimal(16,0)")
    sizes = totals.select("lang", "n", F.explode(F.sequence(F.lit(0), F.lit(JOIN_PARTS - 1))).alias("salt"))
    cuts = parts.join(sizes, ["lang", "salt"]).withColumn(
        "over", F.lit(scale).cast("decimal(5,0)") * number("a") * number("n")).withColumn("under", number("l") * number("r"))
    scored = cuts.withColumn("score", F.expr("over div under")).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    within = candidates.where("length > 2").select("lang", "a", "words", "length", F.explode(F.sequence(F.lit(2), F.col("length") - 1)).alias("m")).select(
        "lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("m") + 1)).alias("at")).groupBy(
        "lang", _part(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))).drop("longer")
    return ranked(kept, top)


def ranked(scored: DataFrame, top: int) -> DataFrame:
    """The first rows of each language: the first of each of its parts, then the first of these."""
    from pyspark.sql import Window

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    dealt = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    last = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

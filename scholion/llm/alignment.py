"""Alignment of two tokenizers' tokens, by divide and conquer at shared cuts.

Both tokenizers cut the same bytes. An interval of tokens is divided at the common end nearest to its
middle, which a bisection in the other tokenizer's ends recognises; an interval without a common end
inside is a group. All intervals of a block of documents are divided together, level by level. The
tokens of a group are linked. How many documents hold a linked pair of ids is counted over the whole
corpus, and comes back to the documents through the dictionaries of their blocks.

Defined cases: texts that are null or empty, or whose bytes a tokenizer doesn't give back, have no
tokens: zeros and an empty text of groups; repeated rows each count and get their result; columns
other than key and text are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm import blocks
from scholion.llm.common import small_batches, stored, tidy
from scholion.llm.word_bpe import arrow_type

#: Characters of the texts in a block.
BLOCK = 2_500_000
#: Parts of texts that are tokenised at once, and tokens of documents that are divided at once.
BATCH, RUN = 5_000, 200_000
#: Characters of the distinct parts that a worker keeps encoded from block to block, with 16 more for each part.
KEPT = 10_000_000
#: Documents that come to a task at once.
AT_ONCE = 500
#: Links of a group beyond which its distinct ids are counted instead of listing its links.
LISTED = 4_096
_SINGLE = re.compile(r"(?<=\S) (?=\S)")


class _Codes(dict):
    def __missing__(self, part: str) -> int:
        self[part] = code = len(self)
        return code


def _cost(parts: list[str]) -> int:
    return sum(map(len, parts)) + 16 * len(parts)


class Pair:
    """Two tokenizers: a byte-level one that gets a space before the text, and one that adds it itself."""

    def __init__(self, first: str, second: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(first)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self._encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        self.pieces = byte_level_pieces(first), sentence_pieces(self.b)
        self.sizes = tuple(map(len, self.pieces))
        self.lengths = tuple(np.array(list(map(len, p)), np.int64) for p in self.pieces)
        self.codes, self.kept = _Codes(), 0
        self.ids, self.counts, self.whole = [np.zeros(0, np.int32)] * 2, [np.zeros(0, np.int64)] * 2, np.zeros(0, bool)

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both, one text after the other, and their numbers for each text; none where one
        tokenizer doesn't give the text's bytes back.

        No token of either crosses a single space between signs, so each distinct part between such
        spaces is encoded once, and not again while it is kept.
        """
        known = len(self.codes)
        of = [np.fromiter(map(self.codes.__getitem__, _SINGLE.split(x) if x else ()), np.int64) for x in texts]
        self._encoded(list(islice(self.codes, known, None)))
        of = [x if self.whole[x].all() else x[:0] for x in of]
        each, sizes = np.concatenate(of), np.array([len(x) for x in of])
        flat = [blocks.gather(ids, n, each).astype(np.int64) for ids, n in zip(self.ids, self.counts)]
        numbers = [sums(n[each], sizes) for n in self.counts]
        if self.kept > KEPT:
            self._forget_all_but(np.unique(each))
        return flat, numbers

    def _forget_all_but(self, stay: np.ndarray) -> None:
        parts = list(self.codes)
        parts = [parts[i] for i in stay.tolist()]
        self.codes, self.kept = _Codes(zip(parts, range(len(parts)))), _cost(parts)
        self.ids = [blocks.gather(ids, n, stay) for ids, n in zip(self.ids, self.counts)]
        self.counts, self.whole = [n[stay] for n in self.counts], self.whole[stay]

    def _encoded(self, parts: list[str]) -> None:
        """Takes in parts that are not known yet, in the order of their numbers."""
        ids, counts, whole = [[x] for x in self.ids], [[x] for x in self.counts], [self.whole]
        for low in range(0, len(parts), BATCH):
            some = parts[low:low + BATCH]
            both = [e.ids for e in self._encode([" " + x for x in some], add_special_tokens=False)], self.b.encode(some, num_threads=1)
            for held, n, own in zip(ids, counts, both):
                n.append(np.fromiter(map(len, own), np.int64, len(own)))
                held.append(np.fromiter(chain.from_iterable(own), np.int32))
            whole.append(self._given_back(some, [x[-1] for x in ids], [x[-1] for x in counts]))
        self.ids, self.counts, self.whole = [np.concatenate(x) for x in ids], [np.concatenate(x) for x in counts], np.concatenate(whole)
        self.kept += _cost(parts)

    def _given_back(self, parts: list[str], ids: list[np.ndarray], sizes: list[np.ndarray]) -> np.ndarray:
        """Whether the pieces of both tokenizers join to the bytes of each part after its space."""
        want = [(" " + x).encode("utf-8", "surrogatepass") for x in parts]
        good = np.ones(len(parts), bool)
        for pieces, lengths, own, n in zip(self.pieces, self.lengths, ids, sizes):
            joined = b"".join(map(pieces.__getitem__, own.tolist()))
            at = blocks.starts(sums(lengths[own], n)).tolist()
            good &= np.fromiter((joined[low:high] == x for low, high, x in zip(at, at[1:], want)), bool, len(want))
        return good


def byte_level_pieces(path: str) -> list[bytes]:
    """The bytes of each id: a printable sign of Latin-1 stands for itself, the other bytes in turn
    for the signs from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    found = {i: bytes(byte_of[c] for c in piece) for piece, i in file["model"]["vocab"].items()}
    found |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    return [found.get(i, b"") for i in range(max(found) + 1)]


def sentence_pieces(model) -> list[bytes]:
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        byte = re.fullmatch("<0x([0-9A-F]{2})>", piece) if model.is_byte(i) else None
        found.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
    return found


@lru_cache(maxsize=2)
def tokenizers(first: str, second: str) -> Pair:
    """One pair of tokenizers per Python worker."""
    return Pair(first, second)


# --- groups

def divide(a_ends: np.ndarray, b_ends: np.ndarray, a_of: np.ndarray, b_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end, as numbers of tokens of both, in order.

    ``a_ends``, ``b_ends``: byte offsets where tokens end, rising; interval i at the start holds the
    tokens from ``a_of[i]`` to ``a_of[i + 1]`` of the first and likewise of the second tokenizer.
    """
    held = (a_of[1:] > a_of[:-1]) & (b_of[1:] > b_of[:-1])
    work = np.stack([a_of[:-1], a_of[1:], b_of[:-1], b_of[1:]], axis=1)[held]
    place = np.searchsorted(b_ends, a_ends)
    shared = b_ends[np.minimum(place, len(b_ends) - 1)] == a_ends if len(b_ends) else np.zeros(len(a_ends), bool)
    done: list[np.ndarray] = []
    while len(work):
        single = (work[:, 1] - work[:, 0] < 2) | (work[:, 3] - work[:, 2] < 2)
        done.append(work[single])
        work = work[~single]
        at, to = _near_middle(work, place, shared)
        done.append(work[at < 0])
        low_a, high_a, low_b, high_b = work[at >= 0].T
        at, to = at[at >= 0] + 1, to[at >= 0] + 1
        work = np.concatenate([np.stack([low_a, at, low_b, to], axis=1), np.stack([at, high_a, to, high_b], axis=1)])
    leaves = np.concatenate(done) if done else np.zeros((0, 4), np.int64)
    return np.sort(leaves[:, 1]), np.sort(leaves[:, 3])


def _near_middle(work: np.ndarray, place: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the first tokenizer's token nearest to the middle that ends where one of the
    second does, before the interval's end, and that token; -1 without one. ``shared``: whether a token
    of the second ends where this one does; ``place``: which."""
    at, to = np.full(len(work), -1, np.int64), np.full(len(work), -1, np.int64)
    low, last = work[:, 0], work[:, 1] - 2
    middle = (low + last) // 2
    open_, reach, before = np.arange(len(work)), 1, 0
    while len(open_):
        m, lo, hi = middle[open_], low[open_], last[open_]
        # offsets from the middle not tried yet, nearest first: 0, 1, -1, 2, -2 ...
        offsets = np.array([o for d in range(before, reach) for o in ((d, -d) if d else (0,))], np.int64)
        tried = m[:, None] + offsets
        inside = (tried >= lo[:, None]) & (tried <= hi[:, None])
        tried = np.where(inside, tried, lo[:, None])
        hit = inside & shared[tried]
        found, first = hit.any(axis=1), hit.argmax(axis=1)
        rows = np.flatnonzero(found)
        at[open_[rows]] = tried[rows, first[rows]]
        to[open_[rows]] = place[at[open_[rows]]]
        open_ = open_[~found & ((m - lo >= reach) | (hi - m >= reach))]
        before, reach = reach, reach * 2
    return at, to


def linked(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, doc_of: np.ndarray, sizes: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, pair of ids) as single numbers in order, and the links of each.

    ``in_a``, ``in_b``: tokens of each group; ``doc_of``: the document of each group.
    """
    small = in_a * in_b <= LISTED
    group_of_a = np.repeat(np.arange(len(in_a)), in_a)
    listed = small[group_of_a]
    g = group_of_a[listed]
    times = in_b[g]
    keys = (np.repeat(doc_of[g] * sizes[0] + a[listed], times)) * sizes[1] + blocks.gather(b, in_b, g)
    found, counts = [keys], [np.ones(len(keys), np.int64)]
    from_a, from_b = blocks.starts(in_a), blocks.starts(in_b)
    for i in np.flatnonzero(~small):
        x, n = np.unique(a[from_a[i]:from_a[i + 1]], return_counts=True)
        y, m = np.unique(b[from_b[i]:from_b[i + 1]], return_counts=True)
        found.append((((doc_of[i] * sizes[0] + x) * sizes[1])[:, None] + y).ravel())
        counts.append((n[:, None] * m).ravel())
    keys, counts = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts


def sums(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of these sizes."""
    return np.diff(blocks.starts(numbers)[blocks.starts(sizes)])


# --- documents

def _run(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, own: Pair) -> dict[str, np.ndarray]:
    """Groups and links of consecutive documents that have so many tokens of both."""
    a_of, b_of, n = blocks.starts(n_a), blocks.starts(n_b), len(n_a)
    to_a, to_b = divide(np.cumsum(own.lengths[0][a]), np.cumsum(own.lengths[1][b]), a_of, b_of)
    in_a, in_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    doc_of = np.searchsorted(a_of, to_a - 1, side="right") - 1
    keys, times = linked(a, b, in_a, in_b, doc_of, own.sizes)
    doc_of_pair, pair = np.divmod(keys, own.sizes[0] * own.sizes[1])
    n_groups = np.bincount(doc_of, minlength=n)
    return {"in_a": in_a, "in_b": in_b, "n_groups": n_groups, "n_links": sums(in_a * in_b, n_groups),
            "n_pairs": np.bincount(doc_of_pair, minlength=n), "pair": pair, "times": times}


def cut(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """Blocks of aligned documents: keys, counts of each, ids, groups, and the dictionary of linked
    pairs with the number of documents that hold each."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind, key_type = arrow_type(rows, "key"), rows.schema["key"].dataType.simpleString()
    numbers, packed = ("n_a", "n_b", "n_groups", "n_links", "n_pairs"), ("a", "b", "in_a", "in_b", "codes", "times")
    names = ["block", "keys", *numbers, *packed, "pairs", "docs"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(first, second)
        for block, held in blocks.in_blocks(batches, size):
            (a, b), (n_a, n_b) = own.tokens([t for _, t in held])
            from_a, from_b = blocks.starts(n_a), blocks.starts(n_b)
            begin = np.flatnonzero(np.diff(from_a[:-1] // RUN, prepend=-1)).tolist()
            runs = [_run(a[from_a[i]:from_a[j]], b[from_b[i]:from_b[j]], n_a[i:j], n_b[i:j], own) for i, j in zip(begin, [*begin[1:], len(held)])]
            of = {"n_a": n_a, "n_b": n_b, "a": a, "b": b} | {n: np.concatenate([r[n] for r in runs]) for n in runs[0]}
            pairs, codes = np.unique(of.pop("pair"), return_inverse=True)
            of["codes"] = codes
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([[k for k, _ in held]], pa.list_(kind)), *[pa.array([of[n].tolist()], pa.list_(pa.int64())) for n in numbers],
                 *[pa.array([blocks.pack(of[n])], pa.binary()) for n in packed],
                 pa.array([pairs.tolist()], pa.list_(pa.int64())), pa.array([np.bincount(codes, minlength=len(pairs)).tolist()], pa.list_(pa.int64()))], names)

    return rows.mapInArrow(tidy(pieces), f"block long, keys array<{key_type}>, {', '.join(f'{n} array<long>' for n in numbers)}, "
                                   f"{', '.join(f'{n} binary' for n in packed)}, pairs array<long>, docs array<long>")


def pair_counts(cuts: DataFrame, second_size: int) -> DataFrame:
    """pair, a, b, docs (documents that hold them linked), best (no id of b has more with this a)."""
    counts = stored(blocks.entries(cuts, "pairs", "docs").groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("docs")).select(
        "pair", F.expr(f"pair div {second_size}").alias("a"), F.expr(f"pair % {second_size}").alias("b"), "docs"))
    highest = counts.groupBy("a").agg(F.max("docs").alias("most"))  # at most one row per id of the first vocabulary
    return counts.join(F.broadcast(highest), "a").select("pair", "a", "b", "docs", (F.col("docs") == F.col("most")).alias("best"))


def align(docs: DataFrame, first: str, second: str, key: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best (links whose pair's document count
    is the highest of its first id), count_sum (of the links' counts), groups (text)."""
    with small_batches(docs.sparkSession, AT_ONCE):
        cuts = blocks.stored_by_block(cut(docs, first, second, key, text, size))
    n_first, n_second = tokenizers(first, second).sizes
    counts = pair_counts(cuts, n_second).select("pair", F.col("docs").alias("count"), "best")
    values = blocks.entries(cuts, "pairs").withColumnRenamed("pairs", "pair").join(counts, "pair").select("block", "at", "count", "best")
    kind = arrow_type(docs, key)
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

    def whole(block: dict, of: pa.Table) -> pa.Table:
        tokenizers.cache_clear()  # the worker may hold what it has cut blocks with
        a, b, in_a, in_b, codes, times = (blocks.unpack(block[n]) for n in ("a", "b", "in_a", "in_b", "codes", "times"))
        count, best = of["count"].to_numpy(), of["best"].to_numpy().astype(np.int64)
        n_pairs = np.array(block["n_pairs"], np.int64)
        found = {n: block[n] for n in names[:4]} | {"n_best": sums(times * best[codes], n_pairs), "count_sum": sums(times * count[codes], n_pairs)}
        groups = _texts(a, b, in_a, in_b, np.array(block["n_a"]) + np.array(block["n_b"]), n_first, n_second)
        return pa.table({"key": pa.array(block["keys"], kind), **{n: pa.array(found[n], pa.int64()) for n in names}, "groups": pa.array(groups, pa.string())})

    schema = f"key {docs.schema[key].dataType.simpleString()}, {', '.join(f'{n} long' for n in names)}, groups string"
    return blocks.rebuilt(cuts.drop("pairs", "docs"), values, whole, schema).withColumnRenamed("key", key)


@lru_cache(maxsize=2)
def _signs(n_first: int, n_second: int) -> list[str]:
    """Texts of ids within and at the end of their part of a group, of the first and the second."""
    return [f"{i}{s}" for i in range(n_first) for s in ",|"] + [f"{i}{s}" for i in range(n_second) for s in ",;"]


def _texts(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, n_tokens: np.ndarray, n_first: int, n_second: int) -> list[str]:
    """Groups of each document as ``a1,a2|b1;a3|b2,b3``."""
    from_a, from_b = blocks.starts(in_a), blocks.starts(in_b)
    order = np.empty(len(a) + len(b), np.int64)
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[from_a[1:] - 1], last_b[from_b[1:] - 1] = 1, 1
    order[np.arange(len(a)) + np.repeat(from_b[:-1], in_a)] = 2 * a + last_a
    order[np.arange(len(b)) + np.repeat(from_a[1:], in_b)] = 2 * (n_first + b) + last_b
    signs, ends = _signs(n_first, n_second), blocks.starts(n_tokens)
    return ["".join(map(signs.__getitem__, order[low:high].tolist()))[:-1] for low, high in zip(ends, ends[1:])]

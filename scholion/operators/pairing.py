"""Pairing files by name: exact keys first, then similar names one to one."""

from __future__ import annotations

import math
import unicodedata
import zlib
from dataclasses import dataclass
from difflib import SequenceMatcher
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.functions.arrays import as_made, let
from scholion.functions.text import SPACE_RUN, strip
from scholion.session import cut_lineage, dealt

CONTENT_SUFFIX = "_content_list"


@F.pandas_udf(T.StringType())
def nfkc(names: pd.Series) -> pd.Series:
    """Compatibility form of names; Spark has no built-in for it."""
    return names.map(lambda n: unicodedata.normalize("NFKC", n), na_action="ignore")


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]+\z", "")


def normalize_key(text: Column, ascii_only: bool = False) -> Column:
    """Lower-case words of a name, parted by single blanks."""
    folded = strip(F.lower(text if ascii_only else nfkc(text)))
    words = F.regexp_replace(F.regexp_replace(folded, "[_-]", " "), r"(?U)[^\w\s]", " ")
    return strip(F.regexp_replace(words, SPACE_RUN, " "))


def normalize_keys(names: DataFrame, side: str, ascii_only: bool = False) -> DataFrame:
    """(name, normalized, token_sorted); the right side loses its content-list suffix."""
    base = stem(F.col("name"))
    if side == "right":
        base = F.regexp_replace(base, f"{CONTENT_SUFFIX}\\z", "")
    keyed = names.withColumn("normalized", normalize_key(base, ascii_only))
    return keyed.withColumn("token_sorted", F.array_join(F.array_sort(F.split("normalized", " ")), " "))


def exact_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names whose key is unique on both sides and equal."""
    def unique(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy("normalized").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias(out)).where(
            "n = 1").drop("n")

    return unique(left, "left_name").join(unique(right, "right_name"), "normalized").select(
        "left_name", "right_name", F.lit(1.0).alias("score"))


# --- similar names

#: Longest chunk in use; more selective than that it need not be.
LONGEST_CHUNK = 8
#: Chunks of this size or more may hold one unmatched character; shorter ones must meet as they are.
SHORTEST_LOOSE = 3
#: Buckets in which grams are counted for the choice of chunks, at any number of names.
BUCKETS = 1 << 16


@dataclass(frozen=True)
class Bound:
    """What a left and a right text with ratio >= s and total length T share, as columns of their lengths.

    They match in order in at least M = ceil(sT/2) characters, so at most d = T - 2M are unmatched, and
    the place of a match differs by no more than what either text leaves unmatched before it. Chunks of
    the left text that don't overlap share these d between them: an unmatched character of the left
    text lies in one chunk at most, and so does one of the right text that stands between two matches.
    Of floor(d/2) + 1 chunks one therefore holds at most one such character, and of d + 1 chunks one
    holds none. Chunks leave a fifth of the text free, so that frequent parts, which half of all names
    may have, can be left out.
    """

    left: Column
    right: Column
    min_score: float

    @property
    def matched(self) -> Column:
        return F.greatest(F.lit(1), F.ceil((self.left + self.right) * self.min_score / 2 - 1e-6).cast("int"))

    @property
    def possible(self) -> Column:
        return self.matched <= F.least(self.left, self.right)

    @property
    def chunks(self) -> Column:
        """struct(size, many) of the left text's chunks."""
        unmatched = self.left + self.right - self.matched * 2

        def size(many: Column) -> Column:
            return F.floor(self.left * 4 / (many * 5)).cast("int")

        def kind(length: Column, many: Column) -> Column:
            return F.struct(length.cast("int").alias("size"), many.cast("int").alias("many"))

        loose, tight = F.floor(unmatched / 2) + 1, unmatched + 1
        return F.when(size(loose) >= SHORTEST_LOOSE, kind(F.least(F.lit(LONGEST_CHUNK), size(loose)), loose)).when(
            size(tight) >= 2, kind(size(tight), tight)).otherwise(kind(F.lit(1), self.left - self.matched + 1))

    def near(self, shift: Column) -> Column:
        """A match that stands so much further right in the right text is possible."""
        return (shift <= self.right - self.matched) & (-shift <= self.left - self.matched)

    def alike(self, left: str, right: str) -> Column:
        """The outlines of two texts do not rule the pair out.

        A text has no more characters that the other lacks than it leaves unmatched; an unmatched character
        breaks two pairs of neighbours of its own text and one of the other.
        """
        def lacking(own: str, other: str, mask: str) -> Column:
            return F.bit_count(F.col(f"{own}.{mask}").bitwiseAND(F.bitwise_not(F.col(f"{other}.{mask}"))))

        def one(own: str, other: str, free: Column, other_free: Column) -> Column:
            return (lacking(own, other, "chars") <= free) & (
                lacking(own, other, "pairs_a") + lacking(own, other, "pairs_b") <= free * 2 + other_free)

        free = self.left - self.matched, self.right - self.matched
        return one(left, right, *free) & one(right, left, *free[::-1])


def chunk_kinds(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """(left_len, right_len, size, many) for the lengths that both sides have and that can reach the score."""
    lengths = (side.select(F.length("text").alias(f"{name}_len")).distinct() for side, name in ((left, "left"), (right, "right")))
    bound = Bound(F.col("left_len"), F.col("right_len"), min_score)
    return next(lengths).crossJoin(F.broadcast(next(lengths))).where(bound.possible).select(
        "left_len", "right_len", bound.chunks.alias("c")).select("left_len", "right_len", "c.*")


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in ("chars", "pairs_a", "pairs_b")]))
def outline(texts: pd.Series) -> pd.DataFrame:
    """Bits for the characters, each with the number of its occurrence, and for the pairs of neighbours."""
    def one(text: str) -> tuple[int, int, int]:
        seen, chars, pairs, before = {}, 0, 0, None
        for c in text:
            seen[c] = nth = seen.get(c, 0) + 1
            chars |= 1 << ((ord(c) * 0x9E3779B1 + nth * 0x85EBCA77) >> 16 & 63)
            if before is not None:
                pairs |= 1 << ((ord(before) * 0x9E3779B1 + ord(c) * 0xC2B2AE3D) >> 16 & 127)
            before = c
        return chars, pairs & (1 << 64) - 1, pairs >> 64

    masks = np.array([one(t) for t in texts], dtype=np.uint64).reshape(-1, 3).view(np.int64)
    return pd.DataFrame(masks, columns=["chars", "pairs_a", "pairs_b"])


def rarest_chunks(counts: np.ndarray):
    """UDF for the starts, from 1, of so many chunks of a text that do not overlap and have the least sum of counts."""
    def one(text: str, size: int, many: int) -> list[int]:
        # a chunk meets most texts by what it has without its first or last character, if that is allowed
        gram = size - 1 if size >= SHORTEST_LOOSE else size
        grams = [int(counts[zlib.crc32(text[i:i + gram].encode()) % BUCKETS]) for i in range(len(text) - gram + 1)]
        weights = [sum(grams[i:i + size - gram + 1]) for i in range(len(text) - size + 1)]
        # least sums of 0, 1, .. chunks that end at a place or before it
        sums = [[0] * (len(text) + 1)]
        for _ in range(many):
            sums.append([math.inf] * size + list(accumulate((s + w for s, w in zip(sums[-1], weights)), min)))
        out, end = [], len(text)
        for level in reversed(sums[1:]):
            end = level.index(level[end]) - size
            out.append(end + 1)
        return out

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def places(texts: pd.Series, sizes: pd.Series, many: pd.Series) -> pd.Series:
        return pd.Series([one(t, s, m) for t, s, m in zip(texts, sizes, many)], dtype=object)

    return places


def starts(length: Column) -> Column:
    """1 up to the length; nothing if it is less."""
    return F.when(length >= 1, F.sequence(F.lit(1), length)).otherwise(F.array().cast("array<int>"))


def gram_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How many grams of the least size that chunks meet by fall into each bucket; serves the choice of chunks only."""
    least = size - 1 if size >= SHORTEST_LOOSE else size
    placed = texts.select("text", F.explode(starts(F.length("text") - least + 1)).alias("at"))
    hashed = placed.select((F.crc32(F.substr("text", F.col("at"), F.lit(least)).cast("binary")) % BUCKETS).alias("bucket"))
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[bucket] = n
    return counts


OUTLINE = ["id", "len", "chars", "pairs_a", "pairs_b"]


def outlined(texts: DataFrame) -> DataFrame:
    """Texts with their ``OUTLINE``. Texts of equal id are told apart in the end."""
    return texts.withColumns({"id": F.xxhash64("text"), "len": F.length("text"), "_o": outline("text")}).select(
        "*", "_o.*").drop("_o")


def chunk_rows(texts: DataFrame, size: int, counts: np.ndarray) -> DataFrame:
    """Keys of a text's rarest chunks: the chunk itself and, if it may hold an unmatched character, without each of its own."""
    places = rarest_chunks(counts)("text", F.lit(size), "many")
    placed = outlined(texts).withColumn("at", F.explode(as_made(places))).withColumn("chunk", F.substr("text", F.col("at"), F.lit(size)))
    keys = [F.col("chunk")]
    if size >= SHORTEST_LOOSE:
        keys += [F.concat(F.substr("chunk", F.lit(1), F.lit(i)), F.substr("chunk", F.lit(i + 2))) for i in range(size)]
    return placed.select(*OUTLINE, "at", F.explode(F.array(*[F.xxhash64(k) for k in keys])).alias("key"))


def gram_rows(texts: DataFrame, size: int) -> DataFrame:
    """Keys that chunks of a similar text may have: grams of their size and, if chunks may hold an unmatched
    character, shorter grams and longer ones without one of their inner characters."""
    at = F.col("at")

    def part(skip: int, length: int) -> Column:
        return F.substr("text", at + skip, F.lit(length))

    found = [(size, part(0, size))]
    if size >= SHORTEST_LOOSE:
        found += [(size - 1, part(0, size - 1))]
        found += [(size + 1, F.concat(part(0, i), part(i + 1, size - i))) for i in range(1, size)]
    placed = outlined(texts).withColumn("at", F.explode(starts(F.col("len") - min(n for n, _ in found) + 1)))
    keys = [F.when(at + n <= F.col("len") + 1, F.xxhash64(gram)) for n, gram in found]
    return placed.select(*OUTLINE, "at", F.explode(F.array(*keys)).alias("key")).where("key IS NOT NULL")


def similar_texts(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """(left_text, right_text) pairs that can reach the score; none that does is missing.

    Pairs are judged where they meet, by the places of the chunk and by the outlines of the texts, so that
    only those that pass are moved. An edit distance that no pair at the score exceeds judges what is left.
    """
    kinds = cut_lineage(chunk_kinds(left, right, min_score))
    bound = Bound(F.col("a.len"), F.col("b.len"), min_score)
    pairs = None
    for size in sorted(row["size"] for row in kinds.select("size").distinct().collect()):
        own = kinds.where(F.col("size") == size)
        lefts = left.join(F.broadcast(own.groupBy("left_len").agg(F.max("many").alias("many"))), F.length("text") == F.col("left_len"))
        rights = right.join(F.broadcast(own.select("right_len").distinct()), F.length("text") == F.col("right_len"))
        a, b = chunk_rows(lefts, size, gram_counts(rights, size)).alias("a"), gram_rows(rights, size).alias("b")
        met = a.join(b, (F.col("a.key") == F.col("b.key")) & bound.possible & bound.near(F.col("b.at") - F.col("a.at")) & bound.alike("a", "b"))
        found = met.select(F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"))
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return left.select(F.col("text").alias("left_text"), F.col("text").alias("right_text")).where("false")
    pairs = pairs.distinct()
    for name, texts in (("left", left), ("right", right)):
        pairs = pairs.join(texts.select(F.xxhash64("text").alias(f"{name}_id"), F.col("text").alias(f"{name}_text")), f"{name}_id")
    whole = Bound(F.length("left_text"), F.length("right_text"), min_score)
    near = F.levenshtein("left_text", "right_text") <= whole.left + whole.right - whole.matched * 2
    return pairs.where(whole.possible & near).select("left_text", "right_text")


@F.pandas_udf(T.DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series, floor: pd.Series) -> pd.Series:
    """Sequence-matcher ratio; 0 where an upper bound is already below the floor."""
    def one(a: str, b: str, least: float) -> float:
        matcher = SequenceMatcher(None, a, b)
        if matcher.real_quick_ratio() < least or matcher.quick_ratio() < least:
            return 0.0
        return matcher.ratio()

    return pd.Series([one(a, b, f) for a, b, f in zip(left, right, floor)])


def candidate_keys(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """Key pairs that can reach the score; none that does is missing."""
    pairs = None
    for variant in ("normalized", "token_sorted"):
        keys = {side: df.select(F.col("normalized").alias(f"{side}_key"), F.col(variant).alias(f"{side}_text")).distinct()
                for side, df in (("left", left), ("right", right))}
        texts = [dealt(cut_lineage(keys[side].select(F.col(f"{side}_text").alias("text")).where("text IS NOT NULL").distinct()))
                 for side in keys]
        found = similar_texts(*texts, min_score).join(keys["left"], "left_text").join(keys["right"], "right_text").select(
            "left_key", "right_key")
        pairs = found if pairs is None else pairs.unionByName(found)
    same = left.select(F.col("normalized").alias("left_key")).distinct().join(
        right.select(F.col("normalized").alias("right_key")).distinct(), F.col("left_key") == F.col("right_key"))
    return pairs.unionByName(same).distinct()


def scored_keys(left: DataFrame, right: DataFrame, min_score: float) -> DataFrame:
    """(left_key, right_key, score) of all key pairs at or above the score."""
    def tokens(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.col("normalized").alias(f"{side}_key"), F.col("token_sorted").alias(f"{side}_tokens")).distinct()

    floor = F.lit(min_score)
    # the keys are read many times over; what they come from may be whole texts
    left, right = (cut_lineage(df.select("normalized", "token_sorted").distinct()) for df in (left, right))
    paired = candidate_keys(left, right, min_score).join(tokens(left, "left"), "left_key").join(
        tokens(right, "right"), "right_key")
    # equal totals of both variants let one bound serve both
    scored = paired.withColumn("score", F.greatest(
        sequence_ratio("left_key", "right_key", floor), sequence_ratio("left_tokens", "right_tokens", floor)))
    return scored.where(F.col("score") >= min_score).select("left_key", "right_key", "score")


def fuzzy_candidates(left: DataFrame, right: DataFrame, min_score: float = 0.85) -> DataFrame:
    """All name pairs at or above the score. Similarity is computed once per pair of keys."""
    pairs = scored_keys(left, right, min_score)
    names = pairs.join(left.select(F.col("normalized").alias("left_key"), F.col("name").alias("left_name")), "left_key")
    return names.join(right.select(F.col("normalized").alias("right_key"), F.col("name").alias("right_name")),
                      "right_key").select("left_name", "right_name", "score")


def _ranked(names: DataFrame, side: str) -> DataFrame:
    return names.select(
        F.col("normalized").alias(f"{side}_key"), F.col("name").alias(f"{side}_name"),
        F.row_number().over(Window.partitionBy("normalized").orderBy("name")).alias(f"{side}_rank"))


def greedy_one_to_one(left: DataFrame, right: DataFrame, scored: DataFrame) -> DataFrame:
    """Best pairs first (score, left name, right name), each name once.

    Works on keys with counters, so copies of a name cost nothing extra: a pair of keys
    that is the best of both, and strictly so, uses up all copies it can at once; on ties
    only the first names are taken. Rounds repeat until no pair is left. Taking mutual
    best pairs first gives the same pairs as going down the sorted list.
    """
    names = {"left": cut_lineage(_ranked(left, "left")), "right": cut_lineage(_ranked(right, "right"))}
    sizes = {s: names[s].groupBy(f"{s}_key").agg(F.count(F.lit(1)).alias(f"{s}_size")) for s in names}
    open_pairs = cut_lineage(
        scored.join(sizes["left"], "left_key").join(sizes["right"], "right_key")
        .withColumn("left_used", F.lit(0).cast("long")).withColumn("right_used", F.lit(0).cast("long")))
    taken = None
    while not open_pairs.isEmpty():
        heads = open_pairs
        for side in names:
            head = names[side].select(f"{side}_key", (F.col(f"{side}_rank") - 1).cast("long").alias(f"{side}_used"),
                                      F.col(f"{side}_name"))
            heads = heads.join(head, [f"{side}_key", f"{side}_used"])
        order = F.struct((-F.col("score")).alias("s"), "left_name", "right_name")
        best = heads
        for side in names:
            top = heads.groupBy(f"{side}_key").agg(
                F.min(order).alias(f"{side}_best"), F.max("score").alias("top"))
            level = heads.groupBy(f"{side}_key", "score").agg(F.count(F.lit(1)).alias("ties")).join(
                top, [f"{side}_key"]).where("score = top").select(
                f"{side}_key", f"{side}_best", F.col("ties").alias(f"{side}_ties"))
            best = best.join(level, f"{side}_key")
        mutual = best.where((order == F.col("left_best")) & (order == F.col("right_best")))
        strict = (F.col("left_ties") == 1) & (F.col("right_ties") == 1)
        round_pairs = cut_lineage(mutual.select(
            "left_key", "right_key", "score", "left_used", "right_used",
            F.when(strict, F.least(F.col("left_size") - F.col("left_used"), F.col("right_size") - F.col("right_used")))
            .otherwise(F.lit(1)).cast("long").alias("n")))
        taken = round_pairs if taken is None else taken.unionByName(round_pairs)
        after = open_pairs
        for side in names:
            use = round_pairs.select(f"{side}_key", F.col("n").alias("_n"))
            after = after.join(use, f"{side}_key", "left").withColumn(
                f"{side}_used", F.col(f"{side}_used") + F.coalesce("_n", F.lit(0))).drop("_n")
        open_pairs = cut_lineage(after.where("left_used < left_size AND right_used < right_size"))
    if taken is None:
        return scored.select(F.lit("").alias("left_name"), F.lit("").alias("right_name"), "score").where("false")
    lefts = taken.join(names["left"], "left_key").where(
        (F.col("left_rank") > F.col("left_used")) & (F.col("left_rank") <= F.col("left_used") + F.col("n")))
    lefts = lefts.withColumn("right_rank", (F.col("right_used") + F.col("left_rank") - F.col("left_used")).cast("int"))
    return lefts.join(names["right"], ["right_key", "right_rank"]).select("left_name", "right_name", "score")


REPORT = "md_name string, content_name string, match_type string, score double"


def pairing_report(left_names: DataFrame, right_names: DataFrame, min_score: float = 0.85) -> DataFrame:
    """Exact, similar and unmatched names of both sides."""
    left_names, right_names = cut_lineage(left_names), cut_lineage(right_names)
    left, right = cut_lineage(normalize_keys(left_names, "left")), cut_lineage(normalize_keys(right_names, "right"))
    exact = cut_lineage(exact_pairs(left, right))
    rest_left = left.join(exact.select(F.col("left_name").alias("name")), "name", "left_anti")
    rest_right = right.join(exact.select(F.col("right_name").alias("name")), "name", "left_anti")
    fuzzy = greedy_one_to_one(rest_left, rest_right, scored_keys(rest_left, rest_right, min_score))
    return _report(left_names, right_names, exact, fuzzy)


def _report(left: DataFrame, right: DataFrame, exact: DataFrame, fuzzy: DataFrame) -> DataFrame:
    def shaped(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.col("left_name").alias("md_name"), F.col("right_name").alias("content_name"),
                         F.lit(kind).alias("match_type"), F.round("score", 6).alias("score"))

    pairs = shaped(exact, "exact_normalized").unionByName(shaped(fuzzy, "fuzzy"))
    none = F.lit(None)
    lonely_left = left.join(pairs.select(F.col("md_name").alias("name")), "name", "left_anti").select(
        F.col("name").alias("md_name"), none.cast("string").alias("content_name"),
        F.lit("unmatched_md").alias("match_type"), none.cast("double").alias("score"))
    lonely_right = right.join(pairs.select(F.col("content_name").alias("name")), "name", "left_anti").select(
        none.cast("string").alias("md_name"), F.col("name").alias("content_name"),
        F.lit("unmatched_content").alias("match_type"), none.cast("double").alias("score"))
    return pairs.unionByName(lonely_left).unionByName(lonely_right)


def report_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("match_type").agg(F.count(F.lit(1)).alias("n"))


def rename_matched(report: DataFrame) -> DataFrame:
    """Target file name of each matched pair."""
    return report.where(F.col("md_name").isNotNull() & F.col("content_name").isNotNull()).select(
        "md_name", "content_name", F.concat(stem(F.col("md_name")), F.lit(f"{CONTENT_SUFFIX}.json")).alias("target_name"))

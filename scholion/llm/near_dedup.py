"""Near-duplicates by order MinHash and banded alignment.

A text's k-mers are its shingles of five words; a k-mer that comes again is told apart by its
number. Each of ``SKETCHES`` hash functions picks the ``PICKS`` smallest labelled k-mers, and they
are joined in the order of the text: texts with the same k-mers in another order differ. Texts that
share a sketch are candidates. A pair is verified by aligning the two rows of k-mers, in the band
outside of which no alignment of the wanted similarity can run; the similarity is
aligned / (all - aligned) and must reach 0.8.

In a group that shares a sketch every member is paired with the group's first one and with its
next neighbours in an order of the sketch's own, not with all others: linear in the group. Groups
are compared in two rounds; the second leaves out pairs that are connected already. Where a group is
still not connected and not all of its pairs were compared (templates, license passages), its texts
meet by a prefix filter on their labelled k-mers instead: no alignment is longer than what two texts
have in common, so a pair that reaches the threshold shares one of the rarest k-mers of both. All such
pairs between different components are verified. A pair at the threshold without repeated or moved
parts is missed by all sketches with probability (1 - 0.8^4)^24, about 3 in a million.

Defined cases: equal texts are one class from the start, empty ones too; null texts are classes of
their own; texts of fewer than five words are one k-mer; case of A-Z and white space don't count;
null keys are allowed; other columns are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scholion.llm.common import small_batches, stored, tidy, unused

SHINGLE, SIMILARITY = 5, 0.8
SKETCHES, PICKS = 24, 4
#: Neighbours in a group that a text is paired with; groups are dealt into parts of about this size for it.
NEIGHBOURS, PART = 3, 256
#: Texts and pairs of texts that a task's Python holds at once.
BATCH_ROWS, PAIR_ROWS = 2_000, 500

_RANDOM = np.random.default_rng(20240607)
_POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))
_ROLL = np.cumprod(np.full(SHINGLE, 0xD6E8FEB86659FD93, dtype=np.uint64))
_SALT = _RANDOM.integers(0, 1 << 63, (2, SKETCHES), dtype=np.uint64)
_ODD = _RANDOM.integers(0, 1 << 63, (2, SKETCHES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_codes(text: str) -> np.ndarray:
    """64-bit codes of the words, A-Z lowered."""
    data = np.frombuffer(text.encode("utf-8", "replace").lower(), dtype=np.uint8)
    at = np.flatnonzero(~_SPACE[data])
    if not len(at):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    within = np.arange(len(at)) - np.repeat(first, np.diff(np.concatenate([first, [len(at)]])))
    longest = int(within.max())
    powers = _POWERS if longest < len(_POWERS) else np.cumprod(np.full(longest + 1, _POWERS[0], dtype=np.uint64))
    return _mixed(np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * powers[within], first))


def kmers(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the text's k-mers in order, and the same labelled with their occurrence."""
    words = word_codes(text)
    size = min(SHINGLE, len(words))
    if not size:
        return words, words
    codes = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for j in range(size):
        codes += words[j:j + len(codes)] * _ROLL[j]
    codes = _mixed(codes + np.uint64(size))
    return codes, _labelled(codes)


def _labelled(codes: np.ndarray) -> np.ndarray:
    """The codes told apart by their occurrence; the same array where none comes again."""
    if not len(codes):
        return codes
    order = np.argsort(codes, kind="stable")
    new = np.concatenate([[True], np.diff(codes[order]) != 0])
    if new.all():
        return codes
    starts = np.maximum.accumulate(np.where(new, np.arange(len(codes)), 0))
    labels = np.empty(len(codes), dtype=np.uint64)
    labels[order] = (np.arange(len(codes)) - starts).astype(np.uint64)
    return np.where(labels > 0, _mixed(codes + labels * np.uint64(0xA24BAED4963EE407)), codes)


def sketches(text: str) -> np.ndarray:
    """One 64-bit code for each hash function; none for a text without words."""
    return _sketches(*kmers(text))


def _sketches(codes: np.ndarray, labelled: np.ndarray) -> np.ndarray:
    if not len(codes):
        return codes
    ranks = (labelled[None, :] ^ _SALT[0][:, None]) * _ODD[0][:, None]
    ranks ^= ranks >> np.uint64(32)
    ranks *= _ODD[1][:, None]
    picks = min(PICKS, len(codes))
    chosen = np.argpartition(ranks, picks - 1, axis=1)[:, :picks] if picks < len(codes) else np.tile(np.arange(picks), (SKETCHES, 1))
    chosen.sort(axis=1)
    joined = _SALT[1].copy()
    for j in range(picks):
        joined = _mixed(joined + codes[chosen[:, j]])
    return joined


def similarity(a: str, b: str) -> float:
    """Aligned k-mers of two texts over all their k-mers, 0 where it is below the threshold."""
    return _aligned(kmers(a)[0], kmers(b)[0])


def _aligned(a: np.ndarray, b: np.ndarray) -> float:
    total = len(a) + len(b)
    needed = SIMILARITY / (1 + SIMILARITY) * total
    if not total or min(len(a), len(b)) < needed - 1e-9:
        return 0.0
    labelled_a, labelled_b = _labelled(a), _labelled(b)
    common, at_a, at_b = np.intersect1d(labelled_a, labelled_b, assume_unique=True, return_indices=True)
    if len(common) < needed - 1e-9:
        return 0.0
    band = max(len(a), len(b)) - int(np.ceil(needed - 1e-9))
    inside = np.abs(at_a - at_b) <= band
    order = np.argsort(at_a[inside])
    path = at_b[inside][order]
    length = len(path)
    if length > 1 and not (np.diff(path) > 0).all():
        tails: list[int] = []
        for p in path.tolist():
            k = bisect_left(tails, p)
            tails[k:k + 1] = [p]
        length = len(tails)
    # the k-mers in common bound any alignment; occurrences pair off otherwise only where k-mers repeat
    if length < len(common) and (labelled_a is not a or labelled_b is not b):
        length = _longest(a, b, band)
    found = length / (total - length)
    return found if found >= SIMILARITY - 1e-9 else 0.0


def _longest(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Length of the longest common subsequence of pairs at most ``band`` apart.

    One row of the table is an integer with a bit for each place of b, 0 where the length grows;
    it holds the places of the band only.
    """
    least = min(len(a), len(b))
    differ = np.flatnonzero(a[:least] != b[:least])
    before = int(differ[0]) if len(differ) else least
    a, b = a[before:], b[before:]
    least -= before
    differ = np.flatnonzero(a[len(a) - least:][::-1] != b[len(b) - least:][::-1])
    after = int(differ[0]) if len(differ) else least
    a, b = a[:len(a) - after], b[:len(b) - after]
    found = before + after
    if not len(a) or not len(b):
        return found
    codes, inverse, counts = np.unique(b, return_inverse=True, return_counts=True)
    places = np.split(np.argsort(inverse, kind="stable"), np.cumsum(counts)[:-1])
    at = np.minimum(np.searchsorted(codes, a), len(codes) - 1)
    whole: dict[int, int] = {}
    lists: dict[int, list[int]] = {}
    row, base, width, step = 0, 0, 0, band + 256
    for i in np.flatnonzero(codes[at] == a).tolist():
        low, high = max(0, i - band), min(len(b), i + band + 1)
        if low >= high:
            break
        if low - base > step:
            if low - base > width:
                row |= ((1 << (low - base - width)) - 1) << width
                width = low - base
            drop = low - base
            found += drop - (row & ((1 << drop) - 1)).bit_count()
            row, base, width = row >> drop, low, width - drop
        if high - base > width:
            row |= ((1 << (high - base + step - width)) - 1) << width
            width = high - base + step
        code = int(at[i])
        if counts[code] > 256:
            if code not in whole:
                bits = np.zeros(len(b), np.uint8)
                bits[places[code]] = 1
                whole[code] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            match = (whole[code] >> low & ((1 << (high - low)) - 1)) << (low - base)
        else:
            if code not in lists:
                lists[code] = places[code].tolist()
            match = 0
            for j in lists[code]:
                if low <= j < high:
                    match |= 1 << (j - base)
        if match:
            both = row & match
            row = (row + both | row & ~match) & ((1 << width) - 1)
    return found + width - row.bit_count()


def uid_of(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, uid, n (k-mers) and sketches of each document with a text, written out without the texts."""
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("key"), uid_of(F.col(text)).alias("uid"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(low, BATCH_ROWS)
                rows_of = [kmers(x.as_py()) for x in batch.column(2)]
                codes, sizes = [_sketches(*r) for r in rows_of], [len(r[0]) for r in rows_of]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.maximum(sizes, 1).astype(np.int64)),
                     pa.array([c.view(np.int64) for c in codes], pa.list_(pa.int64()))], ["key", "uid", "n", "sketches"])

    with small_batches(docs.sparkSession, BATCH_ROWS):
        return stored(rows.mapInArrow(tidy(sketch), f"key {kind}, uid binary, n bigint, sketches array<bigint>"))


def members(found: DataFrame) -> DataFrame:
    """Texts in groups of two or more that share a sketch: sketch, uid, n, the group's size and first text."""
    texts = found.groupBy("uid").agg(F.first("n").alias("n"), F.first("sketches").alias("sketches"))
    each = stored(texts.select("uid", "n", F.explode("sketches").alias("sketch")))
    first = F.min(F.struct(F.xxhash64("uid", "sketch").alias("rank"), "uid", "n"))
    groups = each.groupBy("sketch").agg(F.count(F.lit(1)).alias("size"), first.alias("first")).where(F.col("size") > 1)
    return stored(each.join(groups, "sketch"))


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of rows (uid, n, other) whose lengths allow the similarity."""
    fits = F.least("n", "other.n") >= SIMILARITY * F.greatest("n", "other.n")
    return rows.where(F.col("other").isNotNull() & (F.col("uid") != F.col("other.uid")) & fits).select(
        F.least("uid", "other.uid").alias("a"), F.greatest("uid", "other.uid").alias("b")).distinct()


def first_pairs(grouped: DataFrame) -> DataFrame:
    return _pairs(grouped.select("uid", "n", F.struct("first.uid", "first.n").alias("other")))


def neighbour_pairs(grouped: DataFrame) -> DataFrame:
    part = F.pmod(F.xxhash64("sketch", "uid"), F.ceil(F.col("size") / PART).cast("long"))
    order = Window.partitionBy("sketch", "part").orderBy(F.xxhash64("uid", "sketch"), "uid")
    ahead = [F.lead(F.struct("uid", "n"), k).over(order).alias(f"ahead_{k}") for k in range(1, NEIGHBOURS + 1)]
    beside = grouped.select("sketch", "uid", "n", part.alias("part")).select("uid", "n", *ahead)
    return _pairs(beside.select("uid", "n", F.explode(F.array(*[f"ahead_{k}" for k in range(1, NEIGHBOURS + 1)])).alias("other")))


def open_texts(grouped: DataFrame, roots: DataFrame) -> DataFrame:
    """(uid, root) of the texts in groups that are not connected and had pairs that never met."""
    large = grouped.where(F.col("size") > NEIGHBOURS + 1).select("sketch", "uid")
    rooted = stored(large.join(roots, "uid", "left").select("sketch", "uid", F.coalesce("root", "uid").alias("root")))
    apart = rooted.groupBy("sketch").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(F.col("low") != F.col("high"))
    return rooted.join(apart, "sketch", "left_semi").select("uid", "root").distinct()


def prefix_pairs(rooted: DataFrame, texts: DataFrame) -> DataFrame:
    """All pairs (a, b) of different roots that can reach the similarity, and few others.

    K-mers are ordered by their number of texts, those of one root first: they make no pairs. Of two
    texts that have ``both`` k-mers in common, each has one of these among its first n - both + 1.
    """

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(low, BATCH_ROWS)
                codes = [kmers(x.as_py())[1] for x in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([len(c) for c in codes], pa.int64()),
                     pa.array([c.view(np.int64) for c in codes], pa.list_(pa.int64()))], ["uid", "root", "n", "codes"])

    rows = texts.join(rooted, "uid").select("uid", "root", "text").mapInArrow(tidy(labels), "uid binary, root binary, n bigint, codes array<bigint>")
    with small_batches(texts.sparkSession, BATCH_ROWS):
        each = stored(rows).select("uid", "root", "n", F.explode("codes").alias("code"))
    shared = stored(each.groupBy("code").agg(F.count(F.lit(1)).alias("texts"), F.min("root").alias("low"), F.max("root").alias("high")).where(
        F.col("low") != F.col("high")).select("code", "texts"))
    least = lambda a, b: F.ceil(SIMILARITY / (1 + SIMILARITY) * (a + b) - 1e-9)
    n = F.col("n")
    ordered = each.join(shared, "code").groupBy("uid", "root", "n").agg(F.sort_array(F.collect_list(F.struct("texts", "code"))).alias("codes"))
    # the k-mers of one root come before; the prefix is the longest that any partner asks for
    left = n - F.ceil(SIMILARITY * n - 1e-9) + 1 - (n - F.size("codes"))
    prefix = ordered.where(left > 0).select("uid", "root", "n", F.posexplode(F.slice("codes", F.lit(1), left.cast("int"))).alias("k", "c"), F.size("codes").alias("m"))
    prefix = stored(prefix.select("uid", "root", "n", (n - F.col("m") + F.col("k")).alias("at"), F.col("c.code").alias("code")))
    short = prefix.where(F.col("at") <= n - least(n, n)).alias("x")
    at = lambda name: (F.col(f"x.{name}"), F.col(f"y.{name}"))
    (nx, ny), (ux, uy), (ax, ay), (rx, ry) = at("n"), at("uid"), at("at"), at("root")
    fits = ((nx < ny) | (nx == ny) & (ux < uy)) & (nx >= SIMILARITY * ny - 1e-9) & (ax <= nx - least(nx, ny)) & (ay <= ny - least(nx, ny)) & (rx != ry)
    met = short.join(prefix.alias("y"), (F.col("x.code") == F.col("y.code")) & fits)
    return met.select(F.least(ux, uy).alias("a"), F.greatest(ux, uy).alias("b")).distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts align; ``texts`` has one row (uid, text) for each of them."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            kept = []
            for x, y in ((x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3))):
                for t in (x, y):
                    if t not in held:
                        if len(held) > 64:
                            held.clear()
                        held[t] = kmers(t)[0]
                kept.append(_aligned(held[x] if x in held else kmers(x)[0], held[y]) > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(kept))

    left, right = texts.select(F.col("uid").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("uid").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    with small_batches(texts.sparkSession, PAIR_ROWS):
        return stored(both.mapInArrow(tidy(aligned), "a binary, b binary"))


def components(edges: DataFrame) -> DataFrame:
    """(uid, root) of all ends of the edges: the least uid of each connected component.

    Each round moves every node to its least neighbour and keeps the edges between what they
    moved to; a hub's edges are reduced before they are shuffled.
    """
    roots = None
    edges = stored(edges.select("a", "b").distinct())
    while not edges.isEmpty():
        ends = edges.select(F.col("a").alias("uid"), F.col("b").alias("root")).union(edges.select("b", "a"))
        moved = stored(ends.groupBy("uid").agg(F.least("uid", F.min("root")).alias("root")))
        if roots is None:
            roots = moved
        else:
            step = moved.select(F.col("uid").alias("root"), F.col("root").alias("next"))
            roots = stored(roots.join(step, "root", "left").select("uid", F.coalesce("next", "root").alias("root")))
        to = lambda name: moved.select(F.col("uid").alias(name), F.col("root").alias(f"{name}_to"))
        edges = stored(edges.join(to("a"), "a").join(to("b"), "b").where(F.col("a_to") != F.col("b_to")).select(
            F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct())
    return edges.select(F.col("a").alias("uid"), F.col("b").alias("root")) if roots is None else roots


def roots_of(docs: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """(uid, root) of the texts that are linked to a different text."""
    grouped = members(found)
    ends = lambda pairs: pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct()
    own = docs.where(F.col(text).isNotNull()).select(uid_of(F.col(text)).alias("uid"), F.col(text).alias("text"))
    candidates = grouped.select("uid").distinct()
    texts = stored(own.join(candidates, "uid", "left_semi").dropDuplicates(["uid"]))
    links = verified(first_pairs(grouped), texts)
    roots = components(links)
    at = lambda name: roots.select(F.col("uid").alias(name), F.col("root").alias(f"{name}_root"))
    rest = neighbour_pairs(grouped).join(at("a"), "a", "left").join(at("b"), "b", "left").where(
        F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
    links = links.unionByName(verified(stored(rest), texts))
    roots = components(links)
    unmet = stored(open_texts(grouped, roots))
    if unmet.isEmpty():
        return roots
    return components(links.unionByName(verified(stored(prefix_pairs(unmet, texts)), texts)))


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, class_id (the least key of the class), class_size."""
    found = sketched(docs, key, text)
    roots = roots_of(docs, text, found)
    placed = stored(found.select("key", "uid").join(roots, "uid", "left").select("key", F.coalesce("root", "uid").alias("root")))
    named = placed.groupBy("root").agg(F.min("key").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    alone = docs.where(F.col(text).isNull()).select(F.col(key).alias("key"), F.col(key).alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return placed.join(named, "root").select("key", "class_id", "class_size").unionByName(alone).withColumnRenamed("key", key)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, but only one of each class: the one of the least key.

    Repeated rows of one key and text are reduced before the texts are shuffled.
    """
    mark = unused(docs, "__uid")
    found = sketched(docs, key, text)
    roots = roots_of(docs, text, found)
    placed = found.select("key", "uid").join(roots, "uid", "left").select("key", "uid", F.coalesce("root", "uid").alias("root"))
    uid, kept_key = unused(docs, "__kept_uid"), unused(docs, "__kept_key")
    kept = stored(placed.groupBy("root").agg(F.min(F.struct("key", "uid")).alias("k")).select(
        F.col("k.uid").alias(uid), F.col("k.key").alias(kept_key)))
    own = docs.where(F.col(text).isNotNull()).withColumn(mark, uid_of(F.col(text))).dropDuplicates([mark, key])
    one = own.join(kept, (F.col(mark) == F.col(uid)) & F.col(key).eqNullSafe(F.col(kept_key)), "left_semi")
    return one.select(*docs.columns).unionByName(docs.where(F.col(text).isNull()))

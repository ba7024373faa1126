"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A token is predicted in two steps: its class from the history, then the token within the class.
The most frequent tokens ("head") are dealt to classes by their counts and are predicted from the
history within them too; all other tokens have the class of their spelling and the smoothed share
of their count in it, a token that training never saw included. History features are the previous
token, the one before it (a skip), both together, and the classes of the last three tokens; tokens
and pairs are hashed into rows of weights.

Training sees every training document once, in ``ROUNDS`` slices. In each round the tasks make
gradient updates on their part of a slice, starting from the common weights, and what they changed
is averaged by a tree of shuffles. Counts of all tokens stay in a table in the shared folder.
Frequent tokens are sent to all tasks: at most 1/SHARE of them can reach the share. The rest join
their counts by a shuffle, one row for each rare token of a document.

Defined cases: null texts count as empty, so they are scored as the end alone; without training
documents every token is unseen; repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import fold, stored

END = "\n"
#: Head tokens, their classes, and classes of spelling.
HEAD, HEAD_CLASSES, TAIL_CLASSES = 256, 16, 32
MEMBERS = HEAD // HEAD_CLASSES
CLASSES = HEAD_CLASSES + TAIL_CLASSES
#: Rows of weights that tokens and pairs are hashed into; rows for tokens within head classes.
ROWS, INNER_ROWS = 1 << 14, 1 << 10
#: Share of all tokens from which a token counts as frequent.
SHARE = 1 / (1 << 19)
ROUNDS, RATE, STEP = 3, 0.15, 8192
HELD_TOKENS, FAN_IN = 300_000, 16
#: Gradients of a row that are added up side by side with those of other rows.
LAYERS = 8
SLICE = 65_536
#: Places whose classes are weighed at once, so that their numbers stay in the processor's cache.
NEAR = 1024
LOG10 = np.log(10.0)
_START = CLASSES << 26
_ONES = np.ones(STEP, np.float32)


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def spelling_class(token: Column) -> Column:
    """0 to TAIL_CLASSES - 1 by the last two bytes of the token."""
    return (F.crc32(F.substring(token.cast("binary"), -2, 2)) % TAIL_CLASSES).cast("int")


def training(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.where(fold(F.col(key)) != 1).select(F.col(text).alias("text"))


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) of all tokens of the texts, ends included, written out."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([k.decode() for k in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["token", "n"])
            held.clear()
            return batch

        for batch in batches:
            for x in batch.column(0):
                held.update(tokens_of(x.as_py()))
                held[END.encode()] += 1
                if len(held) > HELD_TOKENS:
                    yield passed()
        yield passed()

    return stored(texts.mapInArrow(counts, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("c")))


class Codes(dict):
    """Token to number: 26 bits of hash, class, member of a head class, place among the frequent tokens plus 1."""

    def __init__(self, frequent: list[bytes]):
        super().__init__()
        self.frequent = {t: i for i, t in enumerate(frequent)}

    def __missing__(self, token: bytes) -> int:
        place = self.frequent.get(token, -1)
        if 0 <= place < HEAD:
            group, member = place // MEMBERS, place % MEMBERS
        else:
            group, member = HEAD_CLASSES + crc32(token[-2:]) % TAIL_CLASSES, 0
        code = (crc32(token) & 0x3FFFFFF) | group << 26 | member << 33 | (place + 1) << 38
        if len(self) > 400_000:
            self.clear()
        self[token] = code
        return code


@dataclass
class Model:
    """Weights by feature row and class, within head classes, and what the counts give."""

    outer: np.ndarray  # rows x CLASSES
    inner: np.ndarray  # INNER_ROWS + 1 x HEAD_CLASSES x MEMBERS
    frequent: list[bytes]
    counts: np.ndarray  # of the frequent tokens
    total: int
    distinct: int
    tail_total: np.ndarray
    tail_distinct: np.ndarray

    @property
    def base(self) -> np.ndarray:
        return np.log10((self.counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def tail(self) -> np.ndarray:
        """log10 of the share of each frequent token in its class of spelling."""
        group = np.array([crc32(t[-2:]) % TAIL_CLASSES for t in self.frequent], dtype=np.int64)
        return np.log10((self.counts + 0.5) / (self.tail_total + 0.5 * (self.tail_distinct + 1))[group]) if len(group) else np.zeros(0)


def untrained(vocabulary: DataFrame) -> Model:
    """The model that the counts alone give; history has no weight yet."""
    sums = vocabulary.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    least = max(1.0, total * SHARE)
    rows = vocabulary.where(F.col("c") >= least).collect()  # at most 1 / SHARE
    rows.sort(key=lambda r: (-r["c"], r["token"]))
    head = [r["token"] for r in rows[:HEAD]]
    tail_total, tail_distinct = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
    for r in vocabulary.where(~F.col("token").isin(head)).groupBy(spelling_class(F.col("token")).alias("k")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        tail_total[r["k"]], tail_distinct[r["k"]] = r["n"], r["v"]
    counts = np.array([r["c"] for r in rows], dtype=np.float64)
    outer = np.zeros((ROWS + 3 * (CLASSES + 1) + 1, CLASSES), np.float32)
    inner = np.zeros((INNER_ROWS + 1, HEAD_CLASSES, MEMBERS), np.float32)
    members = np.full(HEAD, 0.0)
    members[:len(head)] = counts[:HEAD]
    members = members.reshape(HEAD_CLASSES, MEMBERS)
    mass = np.concatenate([members.sum(axis=1), tail_total + 0.5 * (tail_distinct + 1)])
    mass[:HEAD_CLASSES][members.sum(axis=1) == 0] = 1e-30  # no such class
    outer[-1] = np.log(mass / mass.sum())
    inner[-1] = np.log(np.maximum(members, 1e-30) / np.maximum(members.sum(axis=1, keepdims=True), 1e-30))
    return Model(outer, inner, [r["token"].encode() for r in rows], counts, total, distinct, tail_total, tail_distinct)


def slices(codes: Codes, texts: list[str | None], rare: list[Counter] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Codes with three of history before each part, where the parts start, and whose they are.

    ``rare`` gets a counter of the tokens that are not frequent for each text.
    """
    held, starts, owners, size = [], [], [], 0
    for i, x in enumerate(texts):
        found = tokens_of(x)
        found.append(END.encode())
        row = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
        if rare is not None:
            rare.append(Counter(map(found.__getitem__, np.flatnonzero(row >> 38 == 0).tolist())))
        row = np.concatenate([np.full(3, _START, np.int64), row])
        for low in range(3, len(row), SLICE):
            part = row[low - 3:low + SLICE]
            held.append(part)
            starts.append(size)
            owners.append(i)
            size += len(part)
            if size >= SLICE:
                yield np.concatenate(held), np.array(starts), np.array(owners)
                held, starts, owners, size = [], [], [], 0
    if held:
        yield np.concatenate(held), np.array(starts), np.array(owners)


def features(row: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Rows of the weights for the tokens at these places."""
    code = row & 0x3FFFFFF
    group = (row >> 26) & 127
    one, two = code[at - 1], code[at - 2]
    spread = lambda x, salt: (((x * 0x9E3779B1 + salt) & 0xFFFFFFFF) * 0x85EBCA6B & 0xFFFFFFFF) >> (32 - ROWS.bit_length() + 1)
    hashed = [spread(one, 1), spread(two, 2), spread(one * 31 + two * 0x01000193, 3)]
    return hashed + [ROWS + k * (CLASSES + 1) + group[at - 1 - k] for k in range(3)]


def _softmax(logits: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
    """Probabilities of all columns, or of the ``wanted`` one in each row."""
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    sums = logits @ np.ones(logits.shape[1], np.float32)
    if wanted is not None:
        return logits[np.arange(len(logits)), wanted] / sums
    logits /= sums[:, None]
    return logits


def _taken(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``values[rows]`` for rows of a table, which take() copies faster."""
    return values.take(rows, axis=0, mode="clip")


def _inner_row(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (((row[at - 1] & 0x3FFFFFF) * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - INNER_ROWS.bit_length() + 1)).astype(np.int64)


def class_probabilities(model: Model, row: np.ndarray, at: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each class at these places, or of the one in ``group``, and the rows of their features."""
    rows = features(row, at)
    found = np.empty(len(at) if group is not None else (len(at), CLASSES), np.float32)
    held, taken = np.empty((2, min(len(at), NEAR), CLASSES), np.float32)
    for low in range(0, len(at), NEAR):
        near = slice(low, low + NEAR)
        logits = found[near] if group is None else held[:len(found[near])]
        np.take(model.outer, rows[0][near], axis=0, out=logits, mode="clip")
        for f in rows[1:]:
            logits += np.take(model.outer, f[near], axis=0, out=taken[:len(logits)], mode="clip")
        logits += model.outer[-1]
        if group is None:
            _softmax(logits)
        else:
            found[near] = _softmax(logits, group[near])
    return found, rows


def member_probabilities(model: Model, row: np.ndarray, at: np.ndarray, group: np.ndarray, member: np.ndarray | None = None) -> np.ndarray:
    """Of each member of the head classes that the tokens at these places have, or of that one."""
    inner = _taken(model.inner.reshape(-1, MEMBERS), _inner_row(row, at) * HEAD_CLASSES + group)
    return _softmax(inner + _taken(model.inner[-1], group), member)


def _summed(rows: np.ndarray, grad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows and the sum of the gradients of each: the first gradients of all rows at
    once, then the second ones, and so on; the few rows with more than LAYERS take the rest as runs."""
    order = np.argsort(rows.astype(np.uint16) if rows.max() < 1 << 16 else rows, kind="stable")
    found = rows[order]
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    sizes = np.diff(first, append=len(rows))
    sums = _taken(grad, order[first])
    for k in range(1, LAYERS):
        more = np.flatnonzero(sizes > k)
        if not len(more):
            break
        sums[more] = _taken(sums, more) + _taken(grad, order[first[more] + k])
    for i in np.flatnonzero(sizes > LAYERS).tolist():
        rest = _taken(grad, order[first[i] + LAYERS:first[i] + sizes[i]])
        sums[i] += _ONES[:len(rest)] @ rest
    return found[first], sums


def _scattered(weights: np.ndarray, squares: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """A gradient step with steps scaled per row."""
    at, sums = _summed(rows, grad)
    squares[at] += np.einsum("ij,ij->i", sums, sums) / sums.shape[1]
    sums *= (RATE / np.sqrt(squares[at]))[:, None]
    weights[at] = _taken(weights, at) - sums


def learn(model: Model, texts: Iterator[list[str | None]], codes: Codes) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights after updates on the texts, and the number of tokens seen."""
    squares_outer, squares_inner = np.full(len(model.outer), 1.0, np.float32), np.full(len(model.inner) * HEAD_CLASSES, 1.0, np.float32)
    flat = model.inner.reshape(-1, MEMBERS)
    seen = 0
    for batch in texts:
        for row, _, _ in slices(codes, batch):
            places = np.flatnonzero(row != _START)
            for low in range(0, len(places), STEP):
                at = places[low:low + STEP]
                group, member = (row[at] >> 26) & 127, (row[at] >> 33) & 31
                outer, rows = class_probabilities(model, row, at)
                outer[np.arange(len(at)), group] -= 1
                head = np.flatnonzero(group < HEAD_CLASSES)
                for f in rows:
                    _scattered(model.outer, squares_outer, f, outer)
                if len(head):
                    inner = member_probabilities(model, row, at[head], group[head])
                    inner[np.arange(len(head)), member[head]] -= 1
                    _scattered(flat, squares_inner, _inner_row(row, at[head]) * HEAD_CLASSES + group[head], inner)
                seen += len(at)
    return model.outer, model.inner, seen


def dealt(texts: DataFrame, rounds: int) -> DataFrame:
    """The texts in fewer partitions: a round learns from one text in ``rounds``, so a task takes so
    many splits, and fewer changes of the weights are shuffled to be averaged."""
    return texts.coalesce(-(-texts.rdd.getNumPartitions() // rounds) or 1)


def train(texts: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """Rounds of updates in the tasks, each over its slice of the texts; the weights are averaged by tokens seen."""
    session = texts.sparkSession
    shape_outer, shape_inner = model.outer.shape, model.inner.shape
    split = model.outer.size

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = None, 0
        for batch in batches:
            for change, n in zip(batch.column(0), batch.column(1)):
                part = np.frombuffer(change.as_py(), np.float16).astype(np.float32) * n.as_py()
                total, seen = part if total is None else total + part, seen + n.as_py()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([(total / seen).astype(np.float16).tobytes()], pa.binary()), pa.array([seen], pa.int64())], ["change", "seen"])

    texts = dealt(texts, rounds)
    for r in range(rounds):
        shared = session.sparkContext.broadcast(model)

        def updates(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            own = Model(start.outer.copy(), start.inner.copy(), start.frequent, start.counts, start.total, start.distinct, start.tail_total, start.tail_distinct)
            outer, inner, seen = learn(own, (b.column(0).to_pylist() for b in batches), Codes(start.frequent))
            if seen:
                change = np.concatenate([(outer - start.outer).ravel(), (inner - start.inner).ravel()]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array([change.tobytes()], pa.binary()), pa.array([seen], pa.int64())], ["change", "seen"])

        changes = texts.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == r).mapInArrow(updates, "change binary, seen bigint")
        width = texts.rdd.getNumPartitions()
        while width > FAN_IN:
            width = -(-width // FAN_IN)
            changes = changes.repartition(width).mapInArrow(merged, "change binary, seen bigint")
        got = changes.collect()  # at most FAN_IN rows of one model's size
        seen = sum(x["seen"] for x in got)
        for x in got:
            change = np.frombuffer(x["change"], np.float16).astype(np.float32) * (x["seen"] / seen)
            model.outer += change[:split].reshape(shape_outer)
            model.inner += change[split:].reshape(shape_inner)
    return model


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: key, held_out (fold 1), n_tokens, n_known, train_tokens, base_score, score."""
    texts = training(docs, key, text)
    vocabulary = token_counts(texts)
    model = train(texts, untrained(vocabulary), rounds)
    session = docs.sparkSession
    shared = session.sparkContext.broadcast(model)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), (fold(F.col(key)) == 1).alias("held_out"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    names = ["row", "key", "held_out", "n_tokens", "n_frequent", "base", "model", "rare"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        codes, base, tail = Codes(own.frequent), own.base, own.tail()
        scale = np.log10(own.tail_total + 0.5 * (own.tail_distinct + 1))
        whole_scale = np.log10(own.total + 0.5 * (own.distinct + 1))
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                batch = whole.slice(low, 1000)
                bodies = batch.column(3).to_pylist()
                n = len(bodies)
                size, common, sums, gains = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
                rare: list[Counter] = []
                for row, starts, owners in slices(codes, bodies, rare):
                    at = np.flatnonzero(row != _START)
                    group, member, place = (row[at] >> 26) & 127, (row[at] >> 33) & 31, (row[at] >> 38) - 1
                    fine = np.empty(len(at))
                    for k in range(0, len(at), STEP):
                        part = at[k:k + STEP]
                        g = group[k:k + STEP]
                        outer, _ = class_probabilities(own, row, part, g)
                        fine[k:k + STEP] = np.log10(outer)
                        head = np.flatnonzero(g < HEAD_CLASSES)
                        fine[k + head] += np.log10(member_probabilities(own, row, part[head], g[head], member[k + head]))
                    known = place >= 0
                    rest = np.flatnonzero(known & (group >= HEAD_CLASSES))
                    fine[rest] += tail[place[rest]]
                    fine[~known] -= scale[group[~known] - HEAD_CLASSES]
                    of = owners[np.searchsorted(starts, at, side="right") - 1]
                    plain = np.full(len(at), -whole_scale)
                    plain[known] = base[place[known]]
                    size += np.bincount(of, minlength=n)
                    common += np.bincount(of, weights=known, minlength=n).astype(np.int64)
                    sums += np.bincount(of, weights=plain, minlength=n)
                    gains += np.bincount(of, weights=fine, minlength=n)
                flat = [(t.decode(), c) for r in rare for t, c in r.items()]
                offsets = pa.array(np.cumsum([0, *map(len, rare)]).astype(np.int32))
                entries = pa.StructArray.from_arrays([pa.array([t for t, _ in flat], pa.string()), pa.array([c for _, c in flat], pa.int32())], ["token", "n"])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(size), pa.array(common), pa.array(sums),
                                                  pa.array(gains), pa.ListArray.from_arrays(offsets, entries)], names)

    found = stored(rows.mapInArrow(scored, f"row bigint, key {kind}, held_out boolean, n_tokens bigint, n_frequent bigint, base double, model double, "
                                           "rare array<struct<token:string,n:int>>"))
    counted = found.select("row", F.explode("rare").alias("r")).select("row", "r.token", "r.n").join(vocabulary.hint("shuffle_hash"), "token", "left")  # a row a token: nothing to sort
    # the tasks have taken off what a rare token's count is divided by
    count = F.coalesce("c", F.lit(0))
    rare = counted.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * F.log10(count + 0.5)).alias("rare"))
    zero = F.lit(0)
    return found.drop("rare").join(rare, "row", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_frequent") + F.coalesce("known", zero)).cast("long").alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare", zero)).alias("base_score"),
        (F.col("model") + F.coalesce("rare", zero)).alias("score"))

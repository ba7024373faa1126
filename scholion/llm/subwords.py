"""Hashed subword features of texts, and a linear softmax over their averaged embeddings.

A text's features are byte n-grams within its lower-cased words, the word's ends included. The
text's embedding is the mean of the embeddings of its n-grams, and a softmax reads it. Embeddings
and softmax are trained jointly, by minibatch gradient descent in numpy.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from scholion.llm.common import small_batches, tidy

#: Any other ASCII character than a letter separates words.
_SEPARATORS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Texts are put together up to about this size, longer ones are taken apart.
BLOCK_BYTES = 1 << 20
#: Texts whose counts are handed over at once.
COUNTED = 500


@dataclass(frozen=True)
class Shape:
    """n-gram lengths in bytes, hash buckets (a power of two), size of an embedding."""

    lengths: tuple[int, ...]
    buckets: int
    size: int


def plain(text: str | None) -> bytes:
    """Lower-case bytes with single separators, one at each end."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "replace").translate(_SEPARATORS).split()) + b" "


def grams(data: np.ndarray, shape: Shape) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length: the starts of the n-grams that don't cross a word's end, and their buckets."""
    inner = data == 32
    crossed = np.concatenate([[0], np.cumsum(inner, dtype=np.int32)])
    wide = data.astype(np.uint32)
    found = []
    for n in shape.lengths:
        count = len(data) - n + 1
        if count < 1:
            continue
        code = np.full(count, n, dtype=np.uint32)
        for j in range(n):
            code *= np.uint32(0x01000193)
            code ^= wide[j:j + count]
        if n <= 2:
            within = ~(inner[:count] & inner[n - 1:])
        else:
            within = crossed[n - 1:n - 1 + count] == crossed[1:1 + count]
        at = np.flatnonzero(within)
        code = code[at] * np.uint32(0x9E3779B1)
        found.append((at, (code >> np.uint32(32 - shape.buckets.bit_length() + 1)).astype(np.int32)))
    return found


def counted(text: str | None, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets in order, with their shares of all its n-grams."""
    found = [b for _, b in grams(np.frombuffer(plain(text), dtype=np.uint8), shape)]
    buckets, times = np.unique(np.concatenate(found) if found else np.zeros(0, np.int32), return_counts=True)
    return buckets.astype(np.int32), (times / max(1, times.sum())).astype(np.float32)


@dataclass
class Model:
    """Trained embeddings and softmax, folded into one row of scores per bucket."""

    shape: Shape
    labels: list
    scores: np.ndarray  # buckets x labels
    bias: np.ndarray
    temperature: float = 1.0
    floor: float = 0.0  # probabilities below it are rejected
    held_back: tuple | None = None  # probabilities and targets of the rows it was tempered on

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The whole texts' scores; blocks of text are scored at once."""
        out = np.zeros((len(texts), len(self.labels)))
        total = np.zeros(len(texts))
        held, owners, size = [], [], 0
        for i, text in enumerate(texts):
            data = plain(text)
            held.append(data)
            owners.append(i)
            size += len(data)
            if size >= BLOCK_BYTES:
                self._add(held, owners, out, total)
                held, owners, size = [], [], 0
        if held:
            self._add(held, owners, out, total)
        return out / np.maximum(total, 1)[:, None] + self.bias

    def _add(self, held: list[bytes], owners: list[int], out: np.ndarray, total: np.ndarray) -> None:
        data = np.frombuffer(b"".join(held), dtype=np.uint8)
        ends = np.cumsum([len(x) for x in held])
        for at, buckets in grams(data, self.shape):
            # two texts meet in two separators, and no n-gram has both of them
            edges = np.concatenate([[0], np.searchsorted(at, ends)])
            number = np.diff(edges)
            total[owners] += number
            full = np.flatnonzero(number)
            if len(full):
                rows = np.asarray(owners)[full]
                for c in range(len(self.labels)):
                    out[rows, c] += np.add.reduceat(self.scores[:, c][buckets], edges[:-1][full], dtype=np.float64)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return softmax(self.logits(texts) / self.temperature)


def softmax(logits: np.ndarray) -> np.ndarray:
    exp = np.exp(logits - logits.max(axis=1, keepdims=True))
    return exp / exp.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, labels: list, shape: Shape, *,
          epochs: int, rate: float, weights: np.ndarray | None = None, batch: int = 64, decay: float = 0.0, seed: int = 7) -> Model:
    """Joint training of embeddings and softmax by gradient descent with steps scaled per row.

    ``rows`` are the results of ``counted``; ``weights`` weigh the rows.
    """
    rng = np.random.default_rng(seed)
    embeddings = (rng.standard_normal((shape.buckets, shape.size)) * 0.1).astype(np.float32)
    matrix = (rng.standard_normal((shape.size, len(labels))) * 0.5).astype(np.float32)
    bias = np.zeros(len(labels), dtype=np.float32)
    squares, squares_m, squares_b = np.full(shape.buckets, 1e-8, np.float32), np.full_like(matrix, 1e-6), np.full_like(bias, 1e-6)
    weights = np.ones(len(rows), np.float32) if weights is None else weights.astype(np.float32)
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            chosen = order[k:k + batch]
            sizes = np.array([len(rows[i][0]) for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            buckets = np.concatenate([rows[i][0] for i in chosen])
            share = np.concatenate([rows[i][1] for i in chosen])
            mean = np.zeros((len(chosen), shape.size), np.float32)
            full = np.flatnonzero(sizes)
            if len(full):
                mean[full] = np.add.reduceat(embeddings[buckets] * share[:, None], (np.cumsum(sizes) - sizes)[full])
            error = softmax(mean @ matrix + bias)
            error[np.arange(len(chosen)), target[chosen]] -= 1
            error *= weights[chosen][:, None]
            back = (error @ matrix.T)
            grad_m, grad_b = mean.T @ error, error.sum(axis=0)
            squares_m += grad_m**2
            squares_b += grad_b**2
            matrix -= step * 0.1 * grad_m / np.sqrt(squares_m)
            bias -= step * 0.1 * grad_b / np.sqrt(squares_b)
            if len(buckets):
                by = np.argsort(buckets, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], np.diff(buckets[by]) > 0]))
                rows_at = buckets[by][first]
                grad = np.add.reduceat(back[owner[by]] * share[by][:, None], first) + decay * embeddings[rows_at]
                squares[rows_at] += (grad**2).mean(axis=1)
                embeddings[rows_at] -= step * grad / np.sqrt(squares[rows_at])[:, None]
    return Model(shape, labels, np.ascontiguousarray(embeddings @ matrix), bias.astype(np.float64))


def tempered(logits: np.ndarray, target: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The temperature under which held-back rows are likeliest, by a search on a fine grid."""
    weights = np.ones(len(target)) if weights is None else weights

    def loss(t: float) -> float:
        return float(-(np.log(np.maximum(softmax(logits / t)[np.arange(len(target)), target], 1e-12)) * weights).sum())

    return float(min(np.geomspace(0.1, 10, 81), key=loss))


# --- with Spark


def fitted(rows, target: str, order: str, shape: Shape, **options) -> Model:
    """``fit`` of a bounded sample. The texts are counted where they lie, one task trains on the
    counts, and only the finished model comes to the driver.

    ``rows`` has ``text``, the target and a column that fixes the order of training.
    """

    @F.pandas_udf("buckets binary, shares binary")
    def features(texts: pd.Series) -> pd.DataFrame:
        found = [counted(x, shape) for x in texts]
        return pd.DataFrame({"buckets": [b.tobytes() for b, _ in found], "shares": [s.tobytes() for _, s in found]})

    def trained(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = [r for f in frames for r in zip(f["order"].tolist(), f["target"].tolist(), f["buckets"], f["shares"])]
        got.sort(key=lambda r: r[:3])
        sample = [(np.frombuffer(b, np.int32), np.frombuffer(s, np.float32)) for _, _, b, s in got]
        yield pd.DataFrame({"model": [pickle.dumps(fit(sample, [r[1] for r in got], shape, **options))]})

    counts = rows.select(F.col(target).alias("target"), F.col(order).alias("order"), features("text").alias("f")).select(
        "target", "order", "f.buckets", "f.shares")
    with small_batches(rows.sparkSession, COUNTED):  # the counts of a text may be many
        made = counts.repartition(1).mapInPandas(tidy(trained), "model binary").collect()
    # without rows there may be no task either
    return pickle.loads(made[0]["model"]) if made else fit([], [], shape, **options)


def folded(model: Model, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Logits of counted rows."""
    return np.stack([(model.scores[b] * s[:, None]).sum(axis=0) for b, s in rows]) + model.bias


def fit(rows: list[tuple[np.ndarray, np.ndarray]], targets: list, shape: Shape, *, visits: int, rate: float, held_back: int = 8,
        sizes: dict | None = None) -> Model:
    """A model of the rows, tempered on one row in ``held_back`` that training doesn't see.

    Training passes over the rows until it has seen ``visits`` of them. Where labels were drawn at
    different rates, ``sizes`` has the rows of each before the draw, and rows weigh as many.

    With a single label, or no rows, the model gives that label (or None) probability 1.
    """
    labels = sorted(set(targets))
    if len(labels) < 2:
        return Model(shape, labels or [None], np.zeros((shape.buckets, 1), np.float32), np.zeros(1))
    target = np.array([labels.index(t) for t in targets])
    weights = np.ones(len(rows))
    if sizes:
        weights = np.array([sizes[x] for x in labels])[target] / np.bincount(target)[target]
        weights /= weights.mean()
    back = np.arange(len(rows)) % held_back == held_back - 1
    seen = np.flatnonzero(~back)
    model = train([rows[i] for i in seen], target[seen], labels, shape, epochs=-(-visits // len(seen)), rate=rate, weights=weights[seen])
    checked = np.flatnonzero(back)
    if len(checked):
        logits = folded(model, [rows[i] for i in checked])
        model.temperature = tempered(logits, target[checked], weights[checked])
        model.held_back = (softmax(logits / model.temperature), target[checked])
    return model


def draw(key):
    """A number below 2^30 by the hash of a column."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30))


def reach(bound: int, total: int) -> int:
    """The draws below which about ``bound`` of ``total`` rows lie."""
    return int(min(1.0, bound / max(1, total)) * (1 << 30))


def sampled(key, bound: int, total: int):
    """Condition that keeps about ``bound`` of ``total`` rows, by the hash of a column."""
    return draw(key) < reach(bound, total)

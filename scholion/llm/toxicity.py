"""Toxicity by averaged subword embeddings and a linear softmax.

Misspelt and inflected words share n-grams with those seen in training, and so their vectors.
The model is fitted on a bounded sample of labelled documents, half of it for the rarer label if
there are as many, and then reads every whole text. Rows weigh as many as they stand for, so that
scores keep the share of toxic documents.

Defined cases: null and empty texts get the score of a text without n-grams; labels that are null
or belong to no document are not learned; contradicting labels of one document count as toxic;
without both labels in the sample every score is that of the only label; repeated rows are
scored each; other columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.llm import subwords
from scholion.llm.common import fold, unused

SHAPE = subwords.Shape(lengths=(3, 4, 5), buckets=1 << 18, size=8)
#: Labelled documents that the model is fitted on, about and at most.
SAMPLE, MOST = 8_000, 10_000
VISITS, RATE = 60_000, 5.0
TOXIC = 0.5


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = MOST) -> subwords.Model:
    """The model of the labelled documents whose fold is not 0."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rarer = min(sizes, key=lambda label: (sizes[label], -label), default=1)
    rare = min(sizes.get(rarer, 0), sample // 2) if len(sizes) == 2 else 0
    draw = F.lit(False)
    for label, n in sizes.items():
        bound = rare if len(sizes) == 2 and label == rarer else sample - rare
        draw = draw | ((F.col("toxic") == label) & subwords.sampled(F.col("doc_id"), bound, n))
    chosen = known.where(draw).limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").limit(most).withColumn("order", F.xxhash64("doc_id"))
    return subwords.fitted(rows, "toxic", "order", SHAPE, visits=VISITS, rate=RATE, sizes=sizes)


def scored(model: subwords.Model, text: Column, session) -> Column:
    """Score of each text: the probability of label 1."""
    shared = session.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for batch in texts:
            if 1 not in own.labels:
                yield pd.Series([0.0] * len(batch))
            else:
                yield pd.Series(own.probabilities(list(batch))[:, own.labels.index(1)])

    return probability(text)


def score(docs: DataFrame, model: subwords.Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out (fold 0), score, predicted."""
    rows = docs.select(F.col(key), fold(F.col(key)).cast("int").alias("fold"), scored(model, F.col(text), docs.sparkSession).alias("score"))
    return rows.select(key, (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: subwords.Model, text: str = "text") -> DataFrame:
    """The documents, with all their columns, that are not predicted to be toxic."""
    flag = unused(docs, "__toxicity")
    return docs.withColumn(flag, scored(model, F.col(text), docs.sparkSession)).where(F.col(flag) < TOXIC).drop(flag)

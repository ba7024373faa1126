"""Language of a text by averaged subword embeddings and a linear softmax.

The model is fitted on a bounded sample of documents with a language and then reads every whole
text. Its probabilities are tempered on rows that training did not see, and the same rows set the
probability below which a prediction is rejected.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and not accepted;
null languages are not learned; with one language in the sample every text with a letter gets it,
with none it is ``und``; repeated rows are predicted each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm import subwords
from scholion.llm.common import fold

SHAPE = subwords.Shape(lengths=(1, 2, 3), buckets=1 << 16, size=16)
#: Documents that the model is fitted on: of each language, and of all together, about.
SAMPLE, MOST = 1_200, 40_000
VISITS, RATE = 16_000, 2.0
#: Share of wrong ones among the accepted predictions of rows that training didn't see.
WRONG = 0.01
UNKNOWN = "und"


def _floor(probabilities: np.ndarray, target: np.ndarray) -> float:
    """Smallest probability from which on the accepted predictions are right often enough."""
    best = probabilities.max(axis=1)
    order = np.argsort(-best, kind="stable")
    wrong = np.cumsum(probabilities.argmax(axis=1)[order] != target[order])
    good = np.flatnonzero(wrong <= WRONG * np.arange(1, len(order) + 1))
    return float(best[order[good[-1]]]) if len(good) else 1.0


def fit(docs: DataFrame, sample: int = SAMPLE, most: int = MOST) -> subwords.Model:
    """The model of the documents with a language whose fold is not 0.

    Each language is drawn by the hash of its documents, none by its place in the files; the table
    of languages that is sent to the tasks has a row for each label of the model.
    """
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    sizes = known.groupBy("lang").count().collect()
    each = max(1, min(sample, most // max(1, len(sizes))))
    reach = docs.sparkSession.createDataFrame([(r["lang"], subwords.reach(each, r["count"])) for r in sizes], "lang string, reach bigint")
    drawn = known.join(F.broadcast(reach), "lang").where(subwords.draw(F.col("doc_id")) < F.col("reach"))
    # repeated rows of one id are drawn together; the limit is for them
    rows = drawn.limit(2 * most).withColumn("order", F.xxhash64("doc_id"))
    model = subwords.fitted(rows, "lang", "order", SHAPE, visits=VISITS, rate=RATE)
    if model.held_back is not None:
        model.floor = _floor(*model.held_back)
    return model


def predict(docs: DataFrame, model: subwords.Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out (fold 0), lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in texts:
            p = own.probabilities(list(batch))
            yield pd.DataFrame({"lang": [own.labels[i] for i in p.argmax(axis=1)], "score": p.max(axis=1)})

    rows = docs.select(F.col(key), (fold(F.col(key)) == 0).alias("held_out"), guess(F.col(text)).alias("g"),
                       F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    told = F.col("letters") & F.col("g.lang").isNotNull()
    return rows.select(key, "held_out", F.when(told, F.col("g.lang")).otherwise(UNKNOWN).alias("lang_pred"),
                       F.when(told, F.col("g.score")).otherwise(0.0).alias("score"),
                       (told & (F.col("g.score") >= model.floor)).alias("accepted"))

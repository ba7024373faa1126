"""Models are trained in a task; the driver gets the finished one."""

import numpy as np
import pytest

from scholion.llm import subwords


def test_training_happens_outside_the_driver(spark, monkeypatch):
    shape = subwords.Shape((2, 3), 1 << 10, 4)
    rows = [(i, f"{'good clean' if i % 2 else 'bad words'} text {i}", i % 2) for i in range(60)]
    counts = [subwords.counted(t, shape) for _, t, _ in rows]
    expected = subwords.fit(counts, [y for *_, y in rows], shape, visits=600, rate=1.0)
    docs = spark.createDataFrame(rows, "place bigint, text string, label int").repartition(5)

    def refuse(*args, **kwargs):
        raise AssertionError("trained on the driver")

    monkeypatch.setattr(subwords, "train", refuse)
    model = subwords.fitted(docs, "label", "place", shape, visits=600, rate=1.0)
    assert model.labels == [0, 1] and np.allclose(model.scores, expected.scores, atol=1e-5)


@pytest.mark.parametrize("kept, labels", [("false", [None]), ("label = 1", [1])])
def test_few_rows_give_the_plain_model(spark, kept, labels):
    docs = spark.createDataFrame([(1, "a b", 1), (2, "c", 0)], "place bigint, text string, label int").where(kept)
    assert subwords.fitted(docs, "label", "place", subwords.Shape((1,), 64, 2), visits=10, rate=1.0).labels == labels

"""Trained operators: held-out quality, exact counts, odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from scholion.llm import decontamination, language_id, lm_scoring, near_dedup, quality_rules, queries, sharding, subwords, toxicity
from scholion.llm.common import table

SF = "/root/testdata/sf0.001"


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def test_language_of_held_out_texts(spark):
    lang = {r["doc_id"]: r["lang"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    rows = queries.op2_language_id(spark, "/root/testdata/sf0.01").collect()
    assert all(r["held_out"] == (fold(r["doc_id"]) == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows) and np.mean([r["accepted"] for r in rows]) > 0.9


def test_language_of_odd_rows(spark, odd, nothing):
    model = language_id.fit(table(spark, SF, "documents"))
    got = language_id.predict(odd, model).collect()
    assert len(got) == odd.count()
    for r in got:
        if r["doc_id"] in (2, 3, 4):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
    assert language_id.predict(nothing, language_id.fit(nothing)).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.fit(nothing)).collect()} == {"und"}
    # half of another script: a prediction that is not sure is rejected
    assert model.floor > 0


@pytest.fixture(scope="module")
def insults(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(400)]
    rows = []
    for i in range(1500):
        toxic = int(i % 4 == 0)
        words = list(rng.choice(vocabulary, 60))
        if toxic:
            for k in rng.integers(0, 60, 3):
                words[k] = "zwobbel" + rng.choice(["ig", "um", "ei", "te"] if fold(i) else ["haft", "oder"])
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id bigint, quality int, toxic int"), {i: t for i, _, t in rows}


def test_unseen_spellings_are_toxic_too(insults):
    docs, labels, truth = insults
    model = toxicity.fit(docs, labels)
    held = [r for r in toxicity.score(docs, model).collect() if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect()}


def test_toxicity_of_odd_rows(spark, odd, nothing, insults):
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (2, None, 1), (6, 1, 0), (6, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(odd, labels)
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.keep_clean(odd, toxicity.fit(odd, labels.where("false"))).columns == odd.columns


def test_scores_of_a_block_are_those_of_each_text():
    shape = subwords.Shape((2, 3), 256, 2)
    rng = np.random.default_rng(1)
    model = subwords.Model(shape, ["a", "b"], rng.standard_normal((256, 2)).astype(np.float32), np.zeros(2))
    texts = ["one two", None, "", "3", "Straße é", "x " * 5000]
    each = np.concatenate([model.logits([t]) for t in texts])
    assert np.allclose(model.logits(texts), each)
    assert np.allclose(each, subwords.folded(model, [subwords.counted(t, shape) for t in texts]), atol=1e-4)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["\n"]


def unigram(texts):
    counts = Counter(t for i, x in texts if fold(i) != 1 for t in tokens(x))
    return counts, sum(counts.values()), len(counts)


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_base_scores_match_brute_force(spark, odd, name):
    docs = odd if name == "odd" else table(spark, SF, "documents")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts, n, v = unigram(texts)
    want = sorted(((i, fold(i) == 1, len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
                    round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 5)) for i, x in texts), key=repr)
    rows = lm_scoring.score(docs, rounds=1).collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows), key=repr) == want
    assert all(r["score"] < 0 for r in rows)


def test_history_helps_on_held_out_texts(spark):
    rows = [r for r in queries.op5_lm_scoring(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.98 * sum(r["base_score"] for r in rows)


def test_a_task_learns_from_as_many_splits_as_there_are_rounds(spark):
    texts = spark.range(20).selectExpr("cast(id AS string) AS text").repartition(7)
    assert [lm_scoring.dealt(texts, n).rdd.getNumPartitions() for n in (1, 3, 9)] == [7, 3, 1]
    assert sorted(r["text"] for r in lm_scoring.dealt(texts, 3).collect()) == sorted(map(str, range(20)))


def test_probabilities_of_the_next_token_sum_to_one(spark):
    docs = table(spark, SF, "documents")
    texts = lm_scoring.training(docs, "doc_id", "text")
    vocabulary = lm_scoring.token_counts(texts)
    model = lm_scoring.train(texts, lm_scoring.untrained(vocabulary), 1)
    counts = {r["token"]: r["c"] for r in vocabulary.collect()}
    row = np.array([lm_scoring._START] * 3 + [lm_scoring.Codes(model.frequent)[t] for t in (b"the", b"of", b"zz")])
    head = model.frequent[:lm_scoring.HEAD]
    for at in (3, 4, 5):
        outer = lm_scoring.class_probabilities(model, row, np.array([at]))[0][0].astype(float)
        inner = lm_scoring.member_probabilities(model, row, np.array([at] * 8), np.arange(8))
        assert np.allclose(inner.sum(axis=1), 1, atol=1e-5)
        rest = np.zeros(lm_scoring.TAIL_CLASSES)
        for t, c in counts.items():
            if t.encode() not in head:
                rest[zlib.crc32(t.encode()[-2:]) % lm_scoring.TAIL_CLASSES] += c + 0.5
        shares = (rest + 0.5) / (model.tail_total + 0.5 * (model.tail_distinct + 1))  # half a count is left for the unseen
        assert np.allclose(shares, 1) and abs(outer.sum() - 1) < 1e-5


def test_the_class_of_the_third_token_back_is_a_feature():
    row = np.array([lm_scoring._START] * 3 + [3 << 26, 1 << 26, 2 << 26, 0])
    other = row.copy()
    other[3] = 4 << 26
    one, two = (np.array(lm_scoring.features(r, np.array([6]))).ravel() for r in (row, other))
    assert (one != two).sum() == 1 and max(one.max(), two.max()) < lm_scoring.ROWS + 3 * (lm_scoring.CLASSES + 1)


def test_no_training_documents(spark):
    held = next(i for i in range(100) if fold(i) == 1)
    docs = spark.createDataFrame([(held, "only this")], "doc_id bigint, text string")
    r = lm_scoring.score(docs).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0) and r["base_score"] == pytest.approx(0)
    assert lm_scoring.score(docs.where("false")).count() == 0


def test_rare_labels_are_learned_from_all_their_rows(spark, insults):
    docs, labels, truth = insults
    rare = labels.where("toxic = 0 OR doc_id % 16 = 0")
    drawn = toxicity.fit(docs, rare, sample=400, most=1000)
    held = [r for r in toxicity.score(docs, drawn).join(rare, "doc_id").collect() if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.95
    assert any(r["predicted"] for r in held if r["toxic"])


def test_weights_give_back_the_share_of_labels():
    shape = subwords.Shape((1,), 64, 2)
    rows = [subwords.counted("same", shape)] * 200
    model = subwords.fit(rows, [1] * 100 + [0] * 100, shape, visits=4000, rate=1.0, sizes={0: 900, 1: 100})
    assert 0.05 < model.probabilities(["same"])[0, 1] < 0.2


def test_many_languages_are_all_learned(spark):
    rows = [(i, f"{chr(0x3041 + i // 40)} word" * 5, f"l{i // 40:02d}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, sample=30, most=600)
    assert len(model.labels) == 50


def test_helper_columns_of_the_same_name_are_kept(spark, insults):
    docs, labels, _ = insults
    names = ("__toxicity", "__uid", "__kept_uid", "__kept_key", "__rules", "__host", "__row", "shard", "grown_shard")
    rich = docs.limit(40).selectExpr("*", "'a.org' AS source", *[f"doc_id AS `{n}`" for n in names])
    items = spark.createDataFrame([("i", "no such words")], "item_id string, text string")
    model = toxicity.fit(docs, labels)
    for kept in (toxicity.keep_clean(rich, model), near_dedup.keep_one(rich), decontamination.keep_clean(rich, items), quality_rules.keep_good(rich)):
        assert kept.columns == rich.columns
        assert all(r[n] == r["doc_id"] for r in kept.collect() for n in names)
    placed = sharding.assign(rich, 8)
    assert placed.columns == [*rich.columns, "shard_", "grown_shard_"]
    assert all(r["shard"] == r["doc_id"] and 0 <= r["shard_"] < 8 for r in placed.collect())


def test_gradients_of_a_row_add_up():
    rng = np.random.default_rng(1)
    rows, grad = np.minimum(rng.zipf(1.3, 5000), 900), rng.normal(size=(5000, 4)).astype(np.float32)
    want = np.zeros((901, 4))
    np.add.at(want, rows, grad)
    at, sums = lm_scoring._summed(rows, grad)
    assert np.array_equal(at, np.unique(rows)) and np.allclose(sums, want[at], atol=1e-3)


def test_wanted_probabilities_are_those_of_all_in_any_portions(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    texts = lm_scoring.training(docs, "doc_id", "text")
    model = lm_scoring.train(texts, lm_scoring.untrained(lm_scoring.token_counts(texts)), rounds=1)
    row, _, _ = next(lm_scoring.slices(lm_scoring.Codes(model.frequent), [r["text"] for r in docs.limit(20).collect()]))
    at = np.flatnonzero(row != lm_scoring._START)[:3000]
    group, member = (row[at] >> 26) & 127, (row[at] >> 33) & 31
    whole, rows = lm_scoring.class_probabilities(model, row, at)
    assert whole.shape == (len(at), lm_scoring.CLASSES) and np.allclose(whole.sum(axis=1), 1, atol=1e-5)
    head = np.flatnonzero(group < lm_scoring.HEAD_CLASSES)
    inner = lm_scoring.member_probabilities(model, row, at[head], group[head])
    assert np.array_equal(lm_scoring.member_probabilities(model, row, at[head], group[head], member[head]), inner[np.arange(len(head)), member[head]])
    for near in (7, 1024, 1 << 20):
        monkeypatch.setattr(lm_scoring, "NEAR", near)
        assert np.allclose(lm_scoring.class_probabilities(model, row, at)[0], whole, rtol=1e-5)
        assert np.allclose(lm_scoring.class_probabilities(model, row, at, group)[0], whole[np.arange(len(at)), group], rtol=1e-5)


def test_counts_of_rare_tokens_come_without_sorting(spark):
    plan = lm_scoring.score(table(spark, SF, "documents"), rounds=1)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [token" in plan

"""Near-duplicates, benchmark passages and the pipeline, against brute force."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from scholion.llm import common, decontamination, near_dedup, quality_rules, queries, subwords, toxicity
from scholion.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def partition(classes):
    groups = defaultdict(list)
    for i, c in classes:
        groups[c].append(i)
    return sorted(map(sorted, groups.values()))


def brute_classes(texts):
    """Components of all pairs that are equal or align; texts of very different length can't."""
    parent = {i: i for i in texts}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    rows = {i: near_dedup.kmers(x)[1] for i, x in texts.items()}
    order = sorted(texts, key=lambda i: len(rows[i]))
    for k, a in enumerate(order):
        for b in order[k + 1:]:
            if len(rows[a]) < 0.8 * len(rows[b]):
                break
            if texts[a] == texts[b] or near_dedup._aligned(rows[a], rows[b]) > 0:
                parent[find(a)] = find(b)
    return partition((i, find(i)) for i in texts)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        k = int(rng.integers(0, len(words)))
        kind = rng.integers(0, 3)
        words[k:k + (kind != 0)] = [f"n{rng.integers(0, 10**6)}"] if kind < 2 else []
    return words


def test_alignment_is_that_of_the_full_table():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a = [f"w{rng.integers(0, 40)}" for _ in range(int(rng.integers(6, 60)))]
        b = edited(a, rng, int(rng.integers(0, 3)))
        ka, kb = (near_dedup.kmers(" ".join(x))[1].tolist() for x in (a, b))
        n = lcs(ka, kb)
        want = n / (len(ka) + len(kb) - n)
        assert near_dedup.similarity(" ".join(a), " ".join(b)) == (pytest.approx(want) if want >= 0.8 else 0)


def test_repeated_lines_are_aligned_by_content():
    rng = np.random.default_rng(3)
    line = [f"again{i}" for i in range(30)]
    parts = [[f"p{k}w{i}" for i in range(60)] for k in range(10)]
    whole = [w for p in parts for w in p + line]
    cases = [(whole, parts[0] + whole[90:]), (["a"] * 3000, ["a"] * 2900), (whole, line + whole[:-20])]
    for _ in range(40):
        few = [f"r{i}" for i in range(9)]
        a = [w for k in range(12) for w in ([f"u{k}x{i}" for i in range(int(rng.integers(0, 25)))] + few)]
        cases.append((a, edited(a, rng, int(rng.integers(0, 4)))))
    for a, b in cases:
        ka, kb = (near_dedup.kmers(" ".join(x))[0].tolist() for x in (a, b))
        n = lcs(ka, kb)
        want = n / (len(ka) + len(kb) - n)
        assert near_dedup.similarity(" ".join(a), " ".join(b)) == (pytest.approx(want) if want >= 0.8 else 0)
    assert near_dedup.similarity(" ".join(whole), " ".join(cases[0][1])) > 0.95


def test_classes_match_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = queries.op7_order_minhash(spark, SF).collect()
    assert partition((r["doc_id"], r["class_id"]) for r in rows) == brute_classes(texts)


def test_large_groups_of_near_copies(spark):
    rng = np.random.default_rng(4)
    bases = [[f"b{k}w{i}" for i in range(150)] for k in range(3)]
    texts = {i: " ".join(edited(bases[i % 3], rng, 2)) for i in range(900)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert partition((r["doc_id"], r["class_id"]) for r in near_dedup.classes(df).collect()) == brute_classes(texts)
    assert near_dedup.keep_one(df).count() == len(brute_classes(texts))


def test_near_copies_on_one_template(spark):
    rng = np.random.default_rng(5)
    template = [f"t{i}" for i in range(304)]
    own = lambda k, n: [f"own{k}x{i}" for i in range(n)]
    texts = {k: " ".join(template + own(k, 50)) for k in range(600)}
    for k in range(40):
        # of 50 words that follow the template 14 stay: above the threshold for this page, below it for all others
        texts[1000 + k] = " ".join(template + own(k, 14) + own(1000 + k, 36))
    pairs = sorted([[k] for k in range(40, 600)] + [[k, 1000 + k] for k in range(40)])
    similar = lambda a, b: near_dedup.similarity(texts[a], texts[b])
    assert all(similar(k, 1000 + k) >= 0.8 for k in range(40))
    assert not any(similar(*rng.choice(list(range(40, 600)), 2, replace=False)) for _ in range(200)) and not similar(0, 1001)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    assert partition((r["doc_id"], r["class_id"]) for r in near_dedup.classes(df).collect()) == pairs


def test_order_counts():
    words = [f"w{i}" for i in range(200)]
    moved = words[100:] + words[:100]
    assert near_dedup.similarity(" ".join(words), " ".join(moved)) == 0 and near_dedup.similarity("A b c d e f", "a  B c d e f") == 1


def test_near_copies_among_odd_rows(odd, nothing):
    got = near_dedup.classes(odd).collect()
    assert len(got) == odd.count() and near_dedup.classes(nothing).count() == 0
    sizes = {r["doc_id"]: r["class_size"] for r in got}
    assert sizes[1] == 2 and sizes[2] == 1 and sizes[3] == 1 and sizes[4] == 1
    kept = near_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(map(repr, [1, 2, None, None, 3, 4, 5, 6]))


def passages(texts, items, width=10):
    tokens = lambda x: re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    windows = defaultdict(set)
    for i, x in items:
        w = tokens(x)
        for k in range(max(1, len(w) - width + 1) if w and i is not None else 0):
            windows[tuple(w[k:k + width])].add(str(i))
    out = []
    for i, x in texts:
        w, hit, owners = tokens(x), set(), set()
        for size in {len(t) for t in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k:k + size])):
                    hit.update(range(k, k + size))
                    owners |= found
        out.append((i, len(w), sorted(hit), sorted(owners)))
    return sorted(out, key=repr)


def rows_of(found):
    return sorted(((r["doc_id"], r["n_words"], r["hits"], r["items"]) for r in found.collect()), key=repr)


@pytest.mark.parametrize("block", [200_000, 150])
def test_passages_match_brute_force(spark, block):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = passages([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert any(h for _, _, h, _ in want) and rows_of(decontamination.scan(docs, items, block=block)) == want


def test_passages_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "of a few WORDS"), (1, "no id here"), (2, None), (3, "..."), (None, "plain text"), (4, "été naïve"), (10, "été naïve"),
                                   (5, " ".join(["end of it the"] * 4))], "item_id bigint, text string").selectExpr("*", "text AS words", "item_id AS item")
    want = passages([(r["doc_id"], r["text"]) for r in odd.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert rows_of(decontamination.scan(odd, items)) == want and sum(bool(o) for *_, o in want) >= 4
    assert decontamination.scan(nothing, items).count() == 0
    assert {tuple(h) for _, _, h, _ in rows_of(decontamination.scan(odd, items.where("false")))} == {()}
    clean = decontamination.keep_clean(odd, items)
    assert clean.columns == odd.columns and clean.count() == sum(not h for _, _, h, _ in want)


def test_proximity_allows_for_slack(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "a b x y c d")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b c d")], "item_id bigint, text string")
    hit = lambda slack: {r["doc_id"] for r in decontamination.scan(docs, items, slack=slack).collect() if r["hits"]}
    assert hit(0) == {2} and hit(1) == {1, 2} and hit(2) == {1, 2, 3}


def test_pipeline_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stored(stages["quality_rules"](spark, docs, SF))
    assert ids(good) == ids(quality_rules.judge(docs).where("kept")) and good.columns == docs.columns
    harmless = stored(stages["toxicity"](spark, good, SF))
    model = toxicity.fit(good, table(spark, SF, "labels"))
    assert ids(harmless) == ids(toxicity.score(good, model).where("predicted = 0"))
    distinct = stored(stages["near_dedup"](spark, harmless, SF))
    groups = brute_classes({r["doc_id"]: r["text"] for r in harmless.collect()})
    assert ids(distinct) == {g[0] for g in groups} and distinct.count() == len(groups)
    clean = stored(stages["decontamination"](spark, distinct, SF))
    found = passages([(r["doc_id"], r["text"]) for r in distinct.collect()], [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()])
    assert ids(clean) == {i for i, _, h, _ in found if not h} and clean.columns == docs.columns
    last = stages["byte_bpe"](spark, clean, SF)
    assert sorted(corpus_pipeline.run(spark, SF).collect()) == sorted(last.collect())


def test_pipeline_stands_odd_rows(spark, odd):
    from corpus_pipeline import STAGES

    docs = odd.select("doc_id", "text", "lang", "source", "n")
    for _, stage in STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    assert STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_tasks_hold_few_large_rows_at_once(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, asked = spark.conf.get(name), []

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    with common.small_batches(spark, 3):
        assert max(r["n"] for r in spark.range(10).repartition(1).mapInArrow(common.tidy(sizes), "n long").collect()) <= 3
    assert spark.conf.get(name) == before
    for module in (near_dedup, subwords):
        monkeypatch.setattr(module, "small_batches", lambda session, rows: asked.append(rows) or common.small_batches(session, rows))
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(40)) + f" end{i % 2}", i % 2) for i in range(8)], "doc_id bigint, text string, toxic int")
    assert near_dedup.keep_one(docs.drop("toxic")).count() == 1
    assert asked == [near_dedup.BATCH_ROWS, *[near_dedup.PAIR_ROWS] * (len(asked) - 1)] and len(asked) > 1
    toxicity.fit(docs, docs)
    assert asked[-1] == subwords.COUNTED and spark.conf.get(name) == before

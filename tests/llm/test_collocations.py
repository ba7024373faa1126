"""Phrase collocations, against plain counting of all phrases."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scholion.llm import collocations, queries
from scholion.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, longest, min_count, top, share):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i:i + k])) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    held = {p: c for p, c in f.items() if c >= min_count and len(p[1]) > 1}
    found = []
    for (lang, words), a in held.items():
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        if not any(o == lang and len(w) > len(words) and 100 * c >= share * a and any(w[i:i + len(words)] == words for i in range(len(w)))
                   for (o, w), c in held.items()):
            found.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    out = []
    for lang in {x[0] for x in found}:
        of = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[-1], -x[2], x[1].encode()))[:top]
        out += [(lang, i, *x[1:]) for i, x in enumerate(of, 1)]
    return sorted(out)


def rows_of(docs):
    return [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]


@pytest.mark.parametrize("limits", [{}, {"size": 500, "held": 60, "burst": 5, "named": 40}])
def test_phrases_are_those_of_plain_counts(spark, odd, limits):
    random.seed(4)
    signs = ["tab\tbed", "new\x0bline", "a,b;c", "Ünder ÉTÉ été", "x\x1cy", "in the end.", "IN THE END", "und\x00null", "in  the \t end"]
    made = [(" ".join(random.choices(signs, k=random.randint(0, 30))), random.choice(["en", "de", None, "und"])) for _ in range(60)]
    hard = spark.createDataFrame([(t, x, i) for i, (t, x) in enumerate(made)], "text string, lang string, phrase long")
    for docs, least, top in ((odd, 2, 50), (hard, 3, 20), (table(spark, SF, "documents").where("length(text) < 3000"), 8, 40)):
        got = collocations.collocations(docs, min_count=least, top=top, **limits).collect()
        assert sorted(tuple(r[x] for x in NAMES) for r in got) == brute(rows_of(docs), 5, least, top, 100)


def test_a_saturated_map_of_phrases_changes_nothing(spark, monkeypatch):
    docs = table(spark, SF, "documents").where("length(text) < 2000")
    want = brute(rows_of(docs), 4, 6, 30, 90)
    monkeypatch.setattr(collocations, "bitmap", lambda frequent, length: b"\xff" * (1 << (collocations.FILTER_BITS - 3)))
    got = collocations.collocations(docs, longest=4, min_count=6, top=30, share=90).collect()
    assert sorted(tuple(r[x] for x in NAMES) for r in got) == want


@pytest.mark.parametrize("hashed", [1, 100, 1 << 22])
def test_only_phrases_of_frequent_hashes_leave_the_tasks(spark, odd, hashed):
    made = spark.createDataFrame([(" ".join(f"w{i * 7 % 50} x{i}" for i in range(j, j + 40)) + " the end of it", "en" if j % 3 else None) for j in range(60)], "text string, lang string")
    for docs, least in ((made, 5), (odd, 3)):
        cuts = collocations.stored(collocations.cut(docs, size=700))
        for length in (1, 2, 3):
            f = {(r["lang"], r["phrase"]): r["f"] for r in collocations.merged(collocations.runs(cuts, length)).collect()}
            often = collocations.hashed_often(cuts, length, least, hashed=hashed)
            left = {(r["lang"], r["phrase"]): r["f"] for r in collocations.merged(collocations.runs(cuts, length, None, often)).collect()}
            assert left == {k: n for k, n in f.items() if n >= least}  # so few phrases share no hash
            assert 0 < len(left) < len(f)


def test_a_saturated_map_of_hashes_changes_nothing(spark, monkeypatch):
    docs = table(spark, SF, "documents").where("length(text) < 2000")
    want = brute(rows_of(docs), 4, 6, 30, 90)
    monkeypatch.setattr(collocations, "hashed_often", lambda *a, **k: b"\xff" * (1 << (collocations.FILTER_BITS - 3)))
    got = collocations.collocations(docs, longest=4, min_count=6, top=30, share=90).collect()
    assert sorted(tuple(r[x] for x in NAMES) for r in got) == want


def test_no_documents_and_no_phrases(spark, nothing, odd):
    assert collocations.collocations(nothing).collect() == []
    assert collocations.collocations(odd.where("doc_id IN (2, 3, 4)"), min_count=1).collect() == []


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3 * 10**12
    known = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 1), ("en", 2, "a b", big - 1)], "lang string, length int, phrase string, f long")
    totals = spark.createDataFrame([("en", 9 * 10**13)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a, **k: (known, totals))
    row, = collocations.collocations(known).collect()
    assert row["score"] == 1000 * (big - 1) * 9 * 10**13 // (big * (big + 1))


def test_long_texts_are_cut_between_words(monkeypatch):
    text = "One two. three,four\tfive " * 9
    whole = list(collocations.tokens(text))
    monkeypatch.setattr(collocations, "PART", 7)
    assert list(collocations.tokens(text)) == whole


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 6), min_size=3, max_size=3), st.integers(1, 5))), st.integers(1, 6), st.integers(0, 8))
def test_tries_burst_spill_and_keep_all_counts(rows, burst, keep):
    trie, want, got = collocations.HatTrie(3, burst), Counter(), Counter()

    def take(runs):
        for run in runs:
            assert [r for r, _ in run] == sorted({r for r, _ in run})
            for row, count in run:
                got[row] += count

    for i, (words, count) in enumerate(rows):
        row = b"".join(w.to_bytes(4, "big") for w in words)
        want[row] += count
        trie.add(row, count)
        if i % 7 == 6:
            take(trie.spill(keep))
            assert trie.size <= max(keep, 0) or trie.size == trie._weight(trie.root)
    take(trie.spill())
    assert got == want and trie.size == 0


def test_registered_phrases_have_contract_columns(spark):
    assert queries.op12_collocations(spark, SF).columns == list(NAMES)


def test_tasks_get_few_blocks_at_once(spark, monkeypatch):
    seen, stored = [], collocations.stored
    monkeypatch.setattr(collocations, "stored", lambda df: seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))) or stored(df))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    collocations.frequent_phrases(table(spark, SF, "documents").where("length(text) < 300"), longest=2, min_count=3)
    assert seen == [collocations.AT_ONCE] + [collocations.BLOCKS_AT_ONCE] * 3
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before

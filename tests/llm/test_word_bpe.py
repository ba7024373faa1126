"""Encoding through a table of distinct words, against the library on whole texts."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scholion.llm import queries, word_bpe
from scholion.llm.common import table

SF = "/root/testdata/sf0.001"
def both(docs, **options):
    return word_bpe.decode(word_bpe.encode(docs, queries.WORD_BPE, **options), queries.WORD_BPE)


HARD = ["It's HE'LL 'sabc '' ''s l’été—Œuvre ÀÉ×÷ßſ “x”…y a<|b","", " \t\n ", "a\x1cb\x1fc d\u0085e f᠎g", "<|endoftext|>x <|startoftext|> y<|endoftext|>", "ΣΑΣ İstanbul é ́x Ω K ﬁ",
        "日本語 テキスト🙂 '’s I'LL don'T 1234 ３４", "x" * 3000, " a b　c​d﻿e", "\x00 \x01 ﷽ ￿ ", "a" * 40 + " " * 90 + "b"]


@pytest.fixture(scope="module")
def library():
    whole = Tokenizer.from_file(queries.WORD_BPE)
    whole.no_truncation()
    whole.no_padding()

    def of(text):
        ids = whole.encode(text or "", add_special_tokens=False).ids
        return len(ids), np.array(ids, "<u4").tobytes(), whole.decode(ids, skip_special_tokens=False)
    return of


@pytest.mark.parametrize("size", [1 << 24, 300])
def test_encoding_and_decoding_are_those_of_the_library(spark, odd, library, size):
    hard = spark.createDataFrame([(i, x) for i, x in enumerate(HARD)] + [(1, HARD[3])], "doc_id bigint, text string")
    for docs in (odd, hard, table(spark, SF, "documents")):
        got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in both(docs, size=size).collect()]
        assert sorted(got, key=repr) == sorted(((r["doc_id"], *library(r["text"])) for r in docs.collect()), key=repr)


@pytest.mark.parametrize("size", [1 << 24, 300])
def test_decoding_beside_encoding_is_that_of_decode(spark, odd, size):
    hard = spark.createDataFrame([(i, x) for i, x in enumerate(HARD)] + [(1, HARD[3]), (None, None)], "doc_id bigint, text string")
    for docs in (odd, hard):
        beside = word_bpe.encode(docs, queries.WORD_BPE, size=size, decoded=True)
        after = both(docs, size=size)
        assert beside.columns == after.columns and sorted(beside.collect(), key=repr) == sorted(after.collect(), key=repr)
        plan = beside._jdf.queryExecution().executedPlan().toString()
        assert plan.index("FlatMapCoGroupsInArrow") < plan.index("MapInArrow")  # no Python worker behind that of the blocks


def test_parts_of_a_long_text_end_at_white_space(monkeypatch):
    monkeypatch.setattr(word_bpe, "PART", 7)
    for text in (*HARD, "one  two\x1cthree four five " * 5):
        assert list(word_bpe.words(text)) == text.translate({ord(c): 0xE000 + ord(c) for c in word_bpe.SIGNS}).split() \
            or any(c in text for c in word_bpe.SIGNS)


def test_registered_digests(spark, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    rows = queries.op11_word_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, ids, decoded = library(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_no_documents_and_no_words(spark, nothing, odd):
    assert word_bpe.encode(nothing, queries.WORD_BPE).collect() == []
    assert [(r["n_tokens"], r["decoded"]) for r in both(odd.where("doc_id IN (2, 3, 4)")).collect()] == [(0, "")] * 3


def test_ids_join_their_pieces(spark):
    number = lambda *ids: np.array(ids, "<u4").tobytes()
    rows = spark.createDataFrame([(number(320, 49407, 320),), (number(),), (None,), (number(320, 4_000_000_000),)], "ids binary")
    assert [r["decoded"] for r in word_bpe.decode(rows, queries.WORD_BPE).collect()] == ["a</w> <|endoftext|> a</w>", "", None, "a</w>"]


@settings(max_examples=1000, deadline=None)
@given(st.text(st.sampled_from("aA'stdreSM09.-’“…éÉßø_<|> \n^`{~/:@["), max_size=12))
def test_parts_encode_like_the_whole(text):
    whole = word_bpe.tokenizer(queries.WORD_BPE)
    ids = lambda x: whole.encode(x, add_special_tokens=False).ids
    assert [i for w in word_bpe.words(text) for p in word_bpe.parts(w) for i in ids(p)] == ids(text)

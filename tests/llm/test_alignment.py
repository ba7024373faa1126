"""Alignment of two tokenizers, against sets of ends and plain counts of links."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scholion.llm import alignment, queries
from scholion.llm.common import table

SF = "/root/testdata/sf0.001"
HARD = ["", " ", "▁ a", "é́😀 naïve", "=" * 97 + "-" * 41, "<|endoftext|> <s> </s> <unk> <0x41>", "\x00\x01", "日本語テキスト" * 9, "a\r\nb \t c", "ﷺ" * 5]


def brute(texts):
    """Results of all texts together, from the tokenizers' own pieces."""
    first = Tokenizer.from_file(queries.BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    a_piece, b_piece = alignment.byte_level_pieces(queries.BYTE_BPE), alignment.sentence_pieces(second)
    found, holds = [], Counter()
    for text in texts:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_piece[i] for i in a) != whole or b"".join(b_piece[i] for i in b) != whole:
            found.append([])
            continue
        ends = [{int(x) for x in np.cumsum([len(p[i]) for i in ids])} for p, ids in ((a_piece, a), (b_piece, b))]
        groups, shared = [], sorted(ends[0] & ends[1])
        for piece, ids, side in ((a_piece, a, 0), (b_piece, b, 1)):
            at, g = 0, 0
            for i in ids:
                at += len(piece[i])
                if len(groups) == g:
                    groups.append(([], []))
                groups[g][side].append(i)
                g += at == shared[g]
        holds.update({(x, y) for g in groups for x in g[0] for y in g[1]})
        found.append(groups)
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    out = []
    for groups in found:
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                    sum(holds[x] == most[x[0]] for x in links), sum(holds[x] for x in links), text))
    return out


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.mark.parametrize("size", [1 << 24, 400])
def test_alignment_is_that_of_brute_force(spark, odd, size):
    hard = spark.createDataFrame([(i, x) for i, x in enumerate(HARD)] + [(1, HARD[3]), (None, HARD[4])], "doc_id bigint, text string")
    for docs in (odd, hard, table(spark, SF, "documents").where("length(text) < 20000")):
        rows = docs.collect()
        got = [(r["doc_id"], *[r[n] for n in NAMES]) for r in alignment.align(docs, queries.BYTE_BPE, queries.PIECE_BPE, size=size).collect()]
        want = [(r["doc_id"], *x) for r, x in zip(rows, brute([r["text"] for r in rows]))]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_registered_digests(spark):
    rows = table(spark, SF, "documents").collect()
    want = {r["doc_id"]: x for r, x in zip(rows, brute([r["text"] for r in rows]))}
    got = queries.op13_alignment(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        *numbers, text = want[r["doc_id"]]
        assert [r[n] for n in NAMES[:-1]] == numbers
        assert r["groups_sha256"] == (hashlib.sha256(text.encode()).hexdigest() if text else "")


def test_blocks_are_not_shuffled(spark, odd):
    plan = alignment.align(odd, queries.BYTE_BPE, queries.PIECE_BPE)._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan


def test_no_documents(spark, nothing):
    assert alignment.align(nothing, queries.BYTE_BPE, queries.PIECE_BPE).collect() == []


sizes = st.lists(st.integers(1, 4), max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(sizes, sizes), max_size=4))
def test_division_finds_every_shared_end(documents):
    a_ends, b_ends, a_of, b_of, want, base = [], [], [0], [0], [], 0
    for a, b in documents:
        n = min(sum(a), sum(b))
        cut = lambda x: sorted({int(e) for e in np.cumsum(x) if e < n} | ({n} if n else set()))
        a, b = cut(a), cut(b)
        want += [base + e for e in sorted(set(a) & set(b))]
        a_ends += [base + e for e in a]
        b_ends += [base + e for e in b]
        a_of.append(len(a_ends))
        b_of.append(len(b_ends))
        base += n
    a_ends, b_ends, a_of, b_of = (np.array(x, np.int64) for x in (a_ends, b_ends, a_of, b_of))
    to_a, to_b = alignment.divide(a_ends, b_ends, a_of, b_of)
    assert a_ends[to_a - 1].tolist() == want and b_ends[to_b - 1].tolist() == want


def test_long_stretches_without_a_shared_end():
    a, b = np.arange(1, 4001) * 2, np.concatenate([np.arange(0, 4000) * 2 + 1, [8000]])
    assert [x.tolist() for x in alignment.divide(a, b, np.array([0, 4000]), np.array([0, 4001]))] == [[4000], [4001]]


def test_large_groups_are_counted_by_their_ids(monkeypatch):
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 9, 60), rng.integers(0, 7, 50)
    parts = np.array([20, 40]), np.array([30, 20]), np.array([0, 1])
    plain = alignment.linked(a, b, *parts, (9, 7))
    monkeypatch.setattr(alignment, "LISTED", 10)
    assert [x.tolist() for x in alignment.linked(a, b, *parts, (9, 7))] == [x.tolist() for x in plain]


def test_parts_are_encoded_once_for_all_blocks(monkeypatch):
    texts = ["one two three", "two  three\nfour", "", "x" * 70 + " one", "日本語 two", "three one " * 9, "\x00 one"]
    of = lambda own: [[x.tolist() for side in own.tokens([t]) for x in side] for t in texts]
    own, seen = alignment.Pair(queries.BYTE_BPE, queries.PIECE_BPE), []
    encode = own._encode
    own._encode = lambda parts, **how: seen.extend(parts) or encode(parts, **how)
    want = [[x.tolist() for side in alignment.Pair(queries.BYTE_BPE, queries.PIECE_BPE).tokens([t]) for x in side] for t in texts]
    assert of(own) == of(own) == want
    assert len(seen) == len(set(seen))
    monkeypatch.setattr(alignment, "KEPT", 0)
    assert of(own) == of(own) == want

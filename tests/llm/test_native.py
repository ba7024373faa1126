"""Quality rules and sharding: against SQL, against the published shards, and on odd rows."""

import re
import zlib
from collections import Counter

import pytest
from oracle_check import compare, connect

from scholion.llm import quality_rules, queries, sharding
from scholion.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert ok, note


def jump(key, shards):
    """The published algorithm."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_matches_the_algorithm(spark):
    keys = [0, 1, 2, 12345, 2**63, 2**64 - 1, 987654321987654321]
    df = spark.createDataFrame([(str(k),) for k in keys], "k string").selectExpr("k", "cast(k as decimal(20,0)) n")
    for shards in (1, 8, 9, 100, 1000):
        got = {int(r["k"]): r["s"] for r in df.select("k", sharding.jump_shard(df["n"], shards).alias("s")).collect()}
        assert got == {k: jump(k, shards) for k in keys}


def test_sharding_of_odd_rows(spark, odd, nothing):
    rows = sharding.place(odd, 8).collect()
    assert len(rows) == odd.count() and sharding.place(nothing, 8).count() == 0
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 2} == {(1, 0)}
    assert Counter(r["doc_id"] for r in rows)[1] == 2


def test_many_copies_get_slots_of_their_own(spark):
    copies = spark.range(3500).selectExpr("cast(7 as bigint) doc_id", "'same' text")
    slots = sorted(r["slot"] for r in sharding.place(copies, 8).collect())
    assert slots == list(range(3500))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_measures_match_brute_force(spark, odd):
    for docs in (odd, table(spark, SF, "documents")):
        texts = sorted((repr(r["doc_id"]), *brute(r["text"])) for r in docs.collect())
        got = quality_rules.judge(docs).collect()
        assert sorted((repr(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == texts
        for r in got:
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])


def test_bad_hosts_lose_their_documents(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "short"
    rows = [(i, f"{good} {i}", "good") for i in range(40)] + [(100 + i, bad if i % 5 else f"{good} {i}", "bad") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = {r["doc_id"]: (r["host_verdict"], r["kept"]) for r in quality_rules.judge(docs).collect()}
    assert judged[0] == ("trust", True) and judged[100] == ("reject", False)
    assert {r["doc_id"] for r in quality_rules.keep_good(docs).collect()} == {d for d, (_, kept) in judged.items() if kept}


def test_rates_of_small_hosts_are_drawn_to_the_prior(spark):
    rows = [(h, i < bad) for h, n, bad in (("a", 400, 20), ("b", 400, 60), ("c", 400, 40), ("d", 2, 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "host string, short boolean").selectExpr("host", "short", "false repetitive", "false symbols", "false dup_lines")
    rates = {r["host"]: r["rate_short"] for r in quality_rules.host_verdicts(df).collect()}
    assert rates["d"] < 1 and abs(rates["a"] - 0.05) < 0.02


def test_rules_on_odd_rows_and_empty_tables(odd, nothing):
    assert quality_rules.judge(odd).count() == odd.count() and quality_rules.judge(nothing).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns and quality_rules.keep_good(nothing).count() == 0


def test_crc_is_that_of_zlib(spark):
    r = sharding.place(spark.createDataFrame([(1, "é")], "doc_id bigint, text string"), 8).first()
    assert (r["size"], r["text_crc32"]) == (3, zlib.crc32("é".encode()))

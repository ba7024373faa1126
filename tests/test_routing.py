import random

from pyspark.sql import functions as F

from scholion.operators import anchors, windows
from scholion.plans import derived
from scholion.sources.routing_config import load_routing_config


def hits(spark, route, code, name, text):
    row = spark.createDataFrame([("r", "d", 1, "s", name, code, None, None, text)],
                                "run_id string, doc_id string, sample_index int, sample_id string, name string, category_code string, "
                                "category_name string, sample_form string, text string")
    anchor = anchors.anchor_rows(row, route).select(anchors.term_structs(anchors.anchor_labels(F.col("anchor"), route), route).alias("t"))
    return anchor.select(anchors.term_hits(F.lit(text), F.col("t"))).first()[0]


def test_short_codes_know_their_boundaries(spark):
    assert hits(spark, "char", "PI", None, "PI/AuNPs film") == []
    assert hits(spark, "char", "PI", None, "the PI film") == ["PI"]
    assert hits(spark, "char", "PAA", None, "PAAs are") == []
    assert hits(spark, "prop", "PAA", None, "PAAs are") == ["PAA"]


def test_ratio_conflict_needs_markers_on_both_sides(spark):
    df = spark.createDataFrame([("5.6 wt%CNC", "5.6wt %x"), ("5.6 wt%CNC", "7.4 wt%x"), ("5.6 wt%CNC", "none")], "a string, b string")
    found = df.select(anchors.ratio_conflict(anchors.ratio_markers(F.col("a")), anchors.ratio_markers(F.col("b"))))
    assert [r[0] for r in found.collect()] == [False, True, False]


def test_form_plurals_differ_by_route(spark):
    df = spark.range(1).select(*[F.array_sort(anchors.form_mentions(F.lit("Films of inkes, aerogel"), r)).alias(r) for r in ("char", "prop", "proc")])
    row = df.first()
    assert row.char == ["Aerogel", "Film", "Ink"] and row.prop == ["Aerogel"] and row.proc == ["Aerogel", "Film"]


def test_merged_ranges_are_disjoint_and_cover_all_seeds(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        seeds = sorted(rng.sample(range(120), rng.randint(1, 25)))
        rows.append((i, [(max(0, s - 3), min(119, s + 3), 0, False) for s in seeds], seeds))
    df = spark.createDataFrame(rows, "i int, r array<struct<s:int,e:int,segment:int,alone:boolean>>, seeds array<int>")
    for row in df.select("seeds", windows.merge_ranges(F.array_sort("r")).alias("m")).collect():
        spans = [(x.s, x.e) for x in row.m]
        assert all(b[0] > a[1] + 1 for a, b in zip(spans, spans[1:]))
        assert all(any(s <= seed <= e for s, e in spans) for seed in row.seeds)


def test_touching_ranges_join_and_gaps_part(spark):
    ranges = [(0, 2, 0, False), (3, 4, 0, False), (6, 7, 0, False), (8, 9, 8, False)]
    df = spark.createDataFrame([(ranges,)], "r array<struct<s:int,e:int,segment:int,alone:boolean>>")
    merged = df.select(windows.merge_ranges(F.col("r")).alias("m")).first().m
    assert [(x.s, x.e) for x in merged] == [(0, 4), (6, 7), (8, 9)]


def test_dictionary_table(spark):
    table = load_routing_config(spark, "char")
    assert table.where("section = 'keyword'").count() == 63
    assert load_routing_config(spark, "prop").where("section = 'keyword'").count() == 66


def test_required_text_never_hides_a_pattern_hit(spark):
    from scholion.functions.text import alternation, has_required
    from scholion.sources.routing_config import route_config

    lines = derived.docs(spark, "/root/testdata/sf0.001").select(F.explode(F.split("content", "\n")).alias("x"))
    for route in ("char", "prop", "proc"):
        for patterns in route_config(route).keywords.values():
            missed = lines.where(F.col("x").rlike(alternation(patterns)) & ~has_required(F.col("x"), patterns))
            assert missed.isEmpty()

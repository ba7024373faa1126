"""Calls that survive a crash, numbered lines and ordered folds."""

import json
import os
import random

import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.operators import anchors, answers, calls, entities, folds, merge, predict
from scholion.plans import literature, registry
from scholion.sources.jsonl import read_jsonl
from scholion.sources.lines import read_lines

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["committed_calls", "numbered_lines", "folded_predictions"])
def test_query_matches_sql(spark, name):
    ok, note = compare(spark, connect(SF), name, registry.queries()[name], registry.oracles()[name], SF)
    assert ok, note


def settled(found):
    return predict.done_task_ids(answers.parse_responses(found, entities.MAIN_SIGNAL))


def test_a_killed_run_pays_only_its_last_slice_again(spark, tmp_path):
    marks = tmp_path / "calls"
    marks.mkdir()
    tasks = spark.createDataFrame([(f"t{i}", f"text {i}") for i in range(60)], "task_id string, text string")
    slices = {r.task_id: r.s for r in tasks.select("task_id", calls.slice_of(F.col("task_id"), 6).alias("s")).collect()}

    def model(deadly):
        def answer(text):
            if deadly and slices["t" + text[5:]] == 3:
                os._exit(1)  # the worker is gone, and with it the job
            (marks / f"{int(deadly)}-{text}").touch()
            return json.dumps({"文献信息": {}, "聚合物": [], "why": "none" if text.endswith("7") and deadly else text}, ensure_ascii=False)[:None if not (text.endswith("7") and deadly) else 3]
        return answer

    log = calls.CallLog(spark, str(tmp_path / "log"))
    with pytest.raises(Exception):
        log.ask(tasks, model(True), settled, per_commit=10)
    committed = {t for t, s in slices.items() if s < 3}
    assert {r.task_id for r in log.answers().collect()} == committed and {r.slice for r in log.commits().collect()} == {0, 1, 2}
    found = log.ask(tasks, model(False), settled, per_commit=10).collect()
    again = {"t" + p.name.split("text ")[1] for p in marks.iterdir() if p.name.startswith("0-")}
    broken = {t for t in committed if t.endswith("7")}
    assert again == (set(slices) - committed) | broken
    assert len(found) == 60 + len(broken) and {r.attempt for r in found} == {0, 1}
    assert log.ask(tasks, model(True), settled, per_commit=10).count() == len(found)


def test_answers_without_a_commit_are_not_read(spark, tmp_path):
    tasks = spark.createDataFrame([("a", "x"), ("b", "y")], "task_id string, text string")
    log = calls.CallLog(spark, str(tmp_path / "log"))
    assert log.answers() is None and log.ask(tasks.limit(0), str, settled) is None
    assert log.ask(tasks, str.upper, settled, max_slices=0) is None
    predict.predict(tasks, str.lower).write.parquet(str(tmp_path / "log/answers/attempt=0/slice=0"))
    found = log.ask(tasks, str.upper, settled, limit=1)
    assert [(r.task_id, r.raw_text, r.attempt) for r in found.collect()] == [("a", "X", 1)]


def test_a_run_belongs_to_one_input_and_half_a_stage_is_written_again(spark, tmp_path):
    raw = spark.createDataFrame([("a.md", None, "# T\ntext\n# 1 Introduction\nmore")], "file_name string, md5 string, content string")
    base = str(tmp_path / "out")
    model = lambda text: '{"文献信息":{},"聚合物":[{"名称":"PI"}],"why":"w"}'
    assert literature.run(spark, raw, base, "r", model, {}).count() == 1
    os.remove(f"{base}/stage=doc_split/run_id=r/_SUCCESS")
    spark.createDataFrame([], spark.read.parquet(f"{base}/stage=doc_split/run_id=r").schema).write.mode("append").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/stage=doc_split/run_id=r")
    literature.run(spark, raw, base, "r", model, {})
    assert spark.read.parquet(f"{base}/stage=doc_split/run_id=r").count() == 2
    counters = {r.stage: r.counters for r in spark.read.parquet(f"{base}/stage=manifest/run_id=r").collect()}
    assert counters["doc_split"] == {"doc_count": 1} and counters["main_signal_parsed"]["success_count"] == 1
    assert counters["final_merge"] == {"sample_count": 1}
    with pytest.raises(ValueError, match="another input"):
        literature.run(spark, raw.withColumn("content", F.lit("other")), base, "r", model, {})


@pytest.mark.parametrize("sent", [0, 1000])
def test_lines_are_numbered_across_ranges(spark, tmp_path, sent):
    random.seed(1)
    want = {}
    for name in ("a.txt", "b.txt", "c.txt"):
        lines = ["x" * random.randint(0, 60) for _ in range(random.randint(0, 90))]
        (tmp_path / name).write_text("".join(f"{x}{random.choice(['\n', '\r\n'])}" for x in lines))
        want |= {(name, i): x for i, x in enumerate(lines, 1)}
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        rows = read_lines(spark, str(tmp_path), sent).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {(r.file.rsplit("/", 1)[1], r.line): r.value for r in rows} == want and len(rows) == len(want)


def test_a_bad_line_is_named(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2\n{"a": 3}\n')
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    with pytest.raises(Exception, match="x.jsonl, line 3: "):
        read_jsonl(spark, str(tmp_path), schema).collect()
    assert [(r.line, r.a) for r in read_jsonl(spark, str(tmp_path), schema, "skip", positions=True).collect()] == [(1, 1), (4, 3)]


@pytest.mark.parametrize("ranges,fan_in", [(1, 64), (7, 2), (40, 3)])
def test_folds_keep_the_order_of_a_hot_key(spark, monkeypatch, ranges, fan_in):
    monkeypatch.setattr(folds, "FAN_IN", fan_in)
    random.seed(2)
    rows = [(random.choice(["hot", "hot", None, f"k{i % 50}"]), i, (chr(97 + i % 26),) if i % 11 else None) for i in range(3000)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, i long, v struct<t:string>")
    got = folds.ordered_fold(df, ["k"], "i", "v", lambda a, b: {"t": a["t"] + b["t"]}, ranges)
    want = {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        if v:
            want[k] = want.get(k, "") + v[0]
    assert {r.k: (r.n, r.v.t) for r in got.collect()} == {k: (len(t), t) for k, t in want.items()}
    assert folds.ordered_fold(df.limit(0), ["k"], "i", "v", dict, ranges).collect() == []


def test_predictions_merge_with_a_function_of_the_user(spark):
    good = json.dumps({"文献信息": {}, "聚合物": [{"名称": "PI"}], "why": "w"}, ensure_ascii=False)
    rows = [("t", 1, 2, good.replace('"w"', '"c"'), None), ("t", 0, 5, good.replace('"w"', '"a"'), None), ("t", 1, 1, good.replace('"w"', '"b"'), None), ("t", 0, 1, "", "lost")]
    preds = answers.parse_responses(spark.createDataFrame(rows, "task_id string, file_order int, seq int, raw_text string, error string"), entities.MAIN_SIGNAL)
    out = merge.merge_predictions(preds, lambda a, b: a | {"why": a["why"] + b["why"], "samples": a["samples"] + b["samples"]})
    (row,) = out.collect()
    assert row.n == 3 and row.payload.why == "abc" and [s.name for s in row.payload.samples] == ["PI"] * 3


@pytest.mark.parametrize("route", ["char", "prop"])
@pytest.mark.parametrize("at_once", [1, 256])
def test_automata_find_what_the_patterns_match(spark, monkeypatch, route, at_once):
    monkeypatch.setattr(anchors, "SAMPLES_AT_ONCE", at_once)
    random.seed(3)
    labels = ["PI", "PI/CNC", "PI-CNC", "PI / CNC", "Polyimide", "poly", "µm (film)", "ÉTÉ", "a.b*c", "CNCs", "PAA", "PIs"]
    parts = ["PI", "PIs", "PI/CNC", "xPI", "PI-", "pi", "POLYIMIDES", "polyimide", "μM (Film)", "été", "A.B*C", "aXbbc", "CNC", " ", ".", "s", "PAA", "ſ"]
    lines = spark.createDataFrame([("r", f"d{i % 3}", i % 2, i, "".join(random.choices(parts, k=9)) if i % 40 else None) for i in range(400)],
                                  "run_id string, doc_id string, chunk_index int, line_index int, line string")
    term = anchors.term_structs(F.array(*map(F.lit, labels)), route)
    terms = spark.range(3).select(F.lit("r").alias("run_id"), F.concat(F.lit("d"), "id").alias("doc_id"), F.posexplode(term).alias("ord", "t")).where(
        "id < 2").select("run_id", "doc_id", (F.col("ord") % 4).alias("sample_index"), "ord", "t.label", "t.is_code", "t.pattern")
    want = lines.join(terms, ["run_id", "doc_id"]).where(F.rlike("line", F.col("pattern"))).groupBy(
        "run_id", "doc_id", "chunk_index", "line_index", "sample_index").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    found = anchors.match_terms(lines, terms)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) != []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

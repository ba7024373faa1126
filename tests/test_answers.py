import json

from pyspark.sql import functions as F

from scholion.operators import answers, entities, merge, normalize, predict
from scholion.sources import jsonl

CASES = [
    ('{"a": 1}', {"a": 1}), ('```json\n{"a": [1, 2,]}\n```', {"a": [1, 2]}), ('Sure: {"a": {"b": "x}"}} done, "ok": yes', {"a": {"b": "x}"}}),
    ('{"a": [{"b": 1}, {"c": "open', {"a": [{"b": 1}, {"c": "open"}]}), ("no object", None), ('{"a": "q\\"{", "b": 2', {"a": 'q"{', "b": 2}),
]


def test_repair(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    found = [r[0] for r in df.select(answers.repair_json(F.col("t"))).collect()]
    assert [json.loads(f) if f else None for f in found] == [want for _, want in CASES]


def test_errors_tell_empty_json_and_model_apart(spark):
    rows = [("t1", "", None), ("t2", '{"性质":[{"类别":"a"}]}', None), ("t3", "x", "ValueError: y"), ("t4", '{"性质":[]}', None)]
    preds = spark.createDataFrame(rows, "task_id string, raw_text string, error string")
    found = {r.task_id: r.error for r in answers.parse_responses(preds, entities.PROP_RESULT).collect()}
    assert found["t1"] == answers.NO_JSON and found["t2"].startswith(answers.BAD_MODEL)
    assert found["t3"] == "ValueError: y" and found["t4"] is None


def test_resume_skips_only_valid_answers(spark):
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "task_id string")
    preds = spark.createDataFrame([("a", "x", " "), ("b", None, "E: 1"), ("b", "x", "E: 2"), (" ", "x", None)], "task_id string, parse string, error string")
    assert [r[0] for r in predict.pending_tasks(tasks, preds).orderBy("task_id").collect()] == ["b", "c"]


def test_failed_call_becomes_a_row(spark):
    def model(text):
        if text == "bad":
            raise ValueError("no")
        return text.upper()

    tasks = spark.createDataFrame([("a", "ok"), ("b", "bad")], "task_id string, text string")
    rows = {r.task_id: (r.raw_text, r.error) for r in predict.predict(tasks, model, 2, "p", "m").collect()}
    assert rows == {"a": ("OK", None), "b": ("", "ValueError: no")}


def steps(spark, payloads):
    rows = [("t", i, json.dumps({"工艺流程": p}, ensure_ascii=False)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "task_id string, seq int, raw_text string").withColumn("file_order", F.lit(0))
    merged = merge.merge_predictions(answers.parse_responses(df, entities.PROC_RESULT), "proc")
    return merged.first().payload


def test_single_record_keeps_its_steps_apart(spark):
    found = steps(spark, [[{"产物名称": "A"}, {"产物名称": "a "}]])
    assert [s.product_name for s in found] == ["A", "a"]


def test_steps_merge_by_product_and_keep_the_longer_text(spark):
    first = {"产物名称": "A", "原料": [{"原料名称": "x", "来源": "short"}], "后处理步骤": "wash"}
    second = {"产物名称": "a", "产物质量": 2, "原料": [{"原料名称": "X", "来源": "much longer", "free": "1"}, {"原料名称": "y"}], "后处理步骤": ["Wash", "dry"]}
    (step,) = steps(spark, [[first], [second]])
    assert step.product_name == "A" and step.product_mass == 2.0
    assert [(m.name, m.source) for m in step.materials] == [("x", "much longer"), ("y", None)]
    assert step.materials[0].extra == {"free": "1"} and step.post_processing == ["wash", "Wash", "dry"]


def test_nameless_samples_go_and_duplicates_fill_gaps(spark):
    raw = json.dumps({"文献信息": {"唯一文献标识": "doi: 10.1/x."}, "why": "w", "聚合物": [
        {"名称": " PI  film", "聚合物分类编码": "polyimide"}, {"名称": "PI-Film", "聚合物分类编码": "PI", "聚合物分类名称": "Poly / X"},
        {"名称": "PI film", "样本形态": "aerogel"}]}, ensure_ascii=False)
    df = spark.createDataFrame([("d", "t", raw)], "doc_id string, task_id string, raw_text string")
    row = normalize.normalize_documents(answers.parse_responses(df, entities.MAIN_SIGNAL)).first()
    assert row.literature.literature_id == "doi:10.1/x"
    assert [(s.name, s.category_code, s.category_name, s.sample_form, s.sample_id[-2:]) for s in row.samples] == [
        ("PI film", "PI", "Polyimide", "Film", "01"), ("PI film", None, None, "Aerogel", "02")]


def test_jsonl_bad_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1, "b": "é"}\n\n{"a": \n', encoding="utf-8")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert [tuple(r) for r in jsonl.read_jsonl(spark, str(path), schema, "skip").collect()] == [(1, "é")]
    try:
        jsonl.read_jsonl(spark, str(path), schema).select("a").collect()
        raised = False
    except Exception as exc:
        raised = "malformed JSON line" in str(exc)
    assert raised


def test_stage_layout(spark, tmp_path):
    df = spark.createDataFrame([("7", None)], "run_id string, x string")
    path = jsonl.write_stage(df, str(tmp_path), "doc_split")
    assert jsonl.sibling(path, "final_merge").endswith("stage=final_merge/run_id=7")
    assert spark.read.text(path).first()[0] == '{"run_id":"7","x":null}'


def test_first_object_is_found_at_any_depth_and_by_one_regex(spark):
    deep = answers.PLAIN_DEPTH + 4
    shallow = '{"a": [1, {"b": "x}\\"]"}], "c": 2}'
    nested = '{"p": ' + "[" * deep + "1" + "]" * deep + "}"
    texts = [shallow, shallow + " Done. {", nested, nested + " and }", '{"a": [1, 2', '{"a": "x', "{]x", '{"a": 1,, }']
    expected = [shallow, shallow, nested, nested, None, None, "{]", '{"a": 1,, }']
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.f for r in rows.select("i", answers._first_object(F.col("t")).alias("f")).orderBy("i").collect()]
    assert got == expected
    # the regex alone decides for objects that are not too deep, so no mark is followed one by one
    found = rows.where("i < 2").select(F.regexp_extract("t", rf"\A{answers._balanced(answers.PLAIN_DEPTH)}", 0).alias("f")).collect()
    assert [r.f for r in found] == [shallow, shallow]


def test_inputs_with_few_splits_are_dealt_over_the_cores(spark, tmp_path):
    from scholion.session import INPUT_PARTITIONS, dealt

    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    set_to = spark.conf.get(INPUT_PARTITIONS)
    spark.conf.unset(INPUT_PARTITIONS)
    try:
        rows = dealt(spark.read.parquet(str(tmp_path / "t")))
        assert rows.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
        assert sorted(r.id for r in rows.collect()) == list(range(1000))
    finally:
        spark.conf.set(INPUT_PARTITIONS, set_to)

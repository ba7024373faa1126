import json
import time
import uuid

from pyspark.sql import functions as F

from scholion.plans import literature
from scholion.streaming import chunks

PAPER = """# Polyimide films
Abstract text.
# 1 Introduction
PI film is known.
# 2 Experimental
PI film was prepared by casting and dried.
# 3 Results and Discussion
The PI film showed FT-IR bands.
Its tensile strength was high, PI film.
"""


def test_whole_run_with_a_stand_in_model(spark, tmp_path):
    def main_model(text):
        assert "[FRONT_MATTER]" in text
        return json.dumps({"文献信息": {"唯一文献标识": "10.1234/x"}, "聚合物": [{"名称": "PI film", "聚合物分类编码": "PI"}], "why": "w"}, ensure_ascii=False)

    models = {
        "char": lambda text: json.dumps({"表征": {"红外_FTIR": {"峰位_cm_1": ["1776"] if "FTIR" in text else []}}}, ensure_ascii=False),
        "prop": lambda text: json.dumps({"性质": [{"类别": "M", "名称": "tensile", "值": {"单值": 5}, "测试条件": {}}]}, ensure_ascii=False),
        "proc": lambda text: "broken",
    }
    raw = spark.createDataFrame([("a.md", None, PAPER), ("b.md", None, PAPER + "more\n")], "file_name string, md5 string, content string")
    out = literature.run(spark, raw, str(tmp_path / "out"), "r1", main_model, models).collect()
    assert len(out) == 2
    (sample,) = out[0].samples
    assert sample.sample_id == "doi:10.1234/x_PI film_01" and sample.sample_form == "Film"
    assert sample.characterization.ftir.peaks_cm_1 == ["1776"]
    assert [p.value.single.text for p in sample.properties] == ["5"] and sample.process == []


def test_files_of_equal_content_are_worked_on_once(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def model(kind, reply):
        def answer(text):
            (asked / f"{kind}-{uuid.uuid4().hex}-{len(text)}").touch()
            return json.dumps(reply, ensure_ascii=False)
        return answer

    main = model("main", {"文献信息": {}, "聚合物": [{"名称": "PI film", "聚合物分类编码": "PI"}], "why": "w"})
    routes = {"char": model("char", {"表征": {}}), "prop": model("prop", {"性质": []}), "proc": model("proc", {"工艺流程": []})}
    shape = "file_name string, md5 string, content string"
    results = []
    for run_id, names in (("one", ["a.md"]), ("three", ["a.md", "b.md", "c.md"])):
        raw = spark.createDataFrame([(n, None, PAPER) for n in names], shape)
        out = literature.run(spark, raw, str(tmp_path / "out"), run_id, main, routes).collect()
        assert [r.file_name for r in sorted(out, key=lambda r: r.doc_index)] == names and len({str(r.samples) for r in out}) == 1
        results.append(sorted(p.name.split("-")[0] + p.name.split("-")[2] for p in asked.iterdir()))
        for p in asked.iterdir():
            p.unlink()
    assert results[0] == results[1] and len(results[0]) == 4


def test_a_second_run_asks_only_open_tasks(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()
    base = str(tmp_path / "out")

    def model(first):
        def answer(messages):
            (asked / f"{first}-{abs(hash(messages[1]['content']))}").touch()
            assert messages[0] == {"role": "system", "content": "Read."} and "[FRONT_MATTER]" in messages[1]["content"]
            if first and "more" in messages[1]["content"]:
                raise TimeoutError("no answer")
            return json.dumps({"文献信息": {}, "聚合物": [{"名称": "PI", "odd": 1}], "why": "w"}, ensure_ascii=False)
        return answer

    template = {"main_signal": "<system>Read.</system><user>{text}</user>"}
    raw = spark.createDataFrame([("a.md", None, PAPER), ("b.md", None, PAPER.replace("Abstract", "more"))], "file_name string, md5 string, content string")
    assert literature.run(spark, raw, base, "r1", model(True), {}, templates=template).count() == 1
    assert literature.run(spark, raw, base, "r1", model(False), {}, templates=template).count() == 2
    assert sum(p.name.startswith("False") for p in asked.iterdir()) == 1
    counts = {r["stage"]: r["row_count"] for r in spark.read.parquet(f"{base}/stage=manifest/run_id=r1").collect()}
    assert counts["main_signal_parsed"] == 3 and counts["final_merge"] == 2


def test_streamed_chunks_give_complete_prefixes(spark, tmp_path):
    rows = [("a", 0, '{"x":'), ("a", 2, "}"), ("a", 1, "1"), ("a", 3, " end"), ("b", 0, "none")]
    spark.createDataFrame(rows, "response_id string, seq long, chunk string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("response_id string, seq long, chunk string").parquet(str(tmp_path / "in"))
    query = (chunks.prefixes(stream).writeStream.format("memory").queryName("prefixes").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "cp")).start())
    try:  # a query with processing-time timeouts goes on without data, so wait for its rows
        for _ in range(120):
            found = spark.table("prefixes").where(~F.col("is_final")).collect()
            if found or not query.isActive:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert [(r.response_id, r.seq, r.raw_text) for r in found] == [("a", 2, '{"x":1}')]

from pyspark.sql import functions as F

from scholion.operators import context, lines, sectioning


def split(spark, text):
    docs = spark.createDataFrame([("d", text)], "doc_id string, content string")
    rows = sectioning.split_sections(docs, "r").orderBy("chunk_index").collect()
    return [(r.block_id, r.section_title, r.title_level, r.section_number, list(r.line_span), list(r.char_span)) for r in rows]


def test_no_heading_is_one_block(spark):
    assert split(spark, "a\nb") == [("b0001", "__FULL_TEXT__", 0, None, [1, 2], [0, 3])]
    assert split(spark, " \n ") == []


def test_deep_numbers_only_split_everywhere_after_a_preface(spark):
    found = split(spark, "pre\n# 2.1 A\nx\n# 2.1.1 B\ny")
    assert [f[1:4] for f in found] == [("__PREFACE__", 0, None), ("2.1 A", 2, "2.1"), ("2.1.1 B", 3, "2.1.1")]


def test_deep_numbers_do_not_split_beside_top_headings(spark):
    found = split(spark, "pre\n# 1 A\nx\n# 1.1 B\ny\n# C\nz\n")
    assert [(f[1], f[4], f[5]) for f in found] == [("1 A", [1, 6], [0, 22]), ("C", [6, 8], [22, 28])]


def test_heading_only_chain_is_absorbed_to_the_first_body_or_the_end(spark):
    assert [f[1] for f in split(spark, "# A\n# B\ntext\n# C\n# D\n")] == ["A", "C"]


def test_three_d_is_not_a_number_and_blank_titles_have_a_name(spark):
    found = split(spark, "# 3D printing\nx\n#   \ny")
    assert [(f[1], f[3]) for f in found] == [("3D printing", None), ("__UNTITLED__", None)]


def test_sections_cover_the_document(spark):
    text = "a\n\n# 1 X\nb\n# Y\n\nc\n## 2 Z\nd"
    spans = [f[5] for f in split(spark, text)]
    assert spans[0][0] == 0 and spans[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_header_path_blocks_ignore_fences(spark):
    text = "lost\n# A\n```\n# no\n```\n## B\nx\n\ny\n# C\n"
    docs = spark.createDataFrame([("d", text)], "doc_id string, content string")
    rows = sectioning.split_by_header_path(docs).orderBy("chunk_index").collect()
    assert [(r.content_title, r.content) for r in rows] == [("A", "```\n# no\n```"), ("A", "## B\nx  \ny"), ("C", "")]


def test_experiment_goes_on_while_titles_share_the_first_character(spark):
    rows = [(i, t, "c%d" % i) for i, t in enumerate(["T", "1 Introduction", "2 Experimental", "2.1 Films", "3 Results"])]
    chunks = spark.createDataFrame([("d",) + r for r in rows], "doc_id string, chunk_index int, content_title string, content string")
    row = context.paper_context_v1(chunks).first()
    assert row.title == "# T" and row.abstract == "# T\nc0"
    assert row.experiment == "# 2 Experimental\nc2\n\n# 2.1 Films\nc3"


def test_doi_variants(spark):
    texts = ["see https://doi.org/10.1000/a.b).", "doi: 10.1000/x;", "(10.1234/abc-1)", "none", "DOI:https://doi.org/10.99999/q]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(context.extract_doi(F.col("t"))).collect()] == [
        "10.1000/a.b", "10.1000/x", "10.1234/abc-1", None, "10.99999/q"]


def test_process_segments_drop_what_precedes_the_first_title(spark):
    text = "intro words without title\nFilm casting.\nbody\nDrying. The film was dried!\nend"
    row = spark.createDataFrame([("r", "d", 0, "Methods", text)], "run_id string, doc_id string, chunk_index int, section_title string, content string")
    found = lines.pseudo_heading_segments(row).orderBy("segment").collect()
    assert [(f.segment_title, f.start, f.stop) for f in found] == [("Film casting", 1, 3), ("Drying", 3, 5)]


def test_human_chunks_are_written_in_order(spark, tmp_path):
    rows = [("r", f"d{i}", k, f"{i}-{k}") for i in range(6) for k in (2, 0, 1)]
    chunks = spark.createDataFrame(rows, "run_id string, doc_id string, chunk_index int, chunk_text string")
    sectioning.write_human_chunks(chunks, str(tmp_path / "out"), folders=2)
    files = [p.read_text() for p in (tmp_path / "out").rglob("part-*.txt")]
    assert 1 <= len(files) <= 2
    records = [r for text in files for r in text.split("\n\f\n") if r]
    assert sorted(records) == sorted(r[3] for r in rows)
    for i in range(6):
        assert [r for r in records if r.startswith(f"{i}-")] == [f"{i}-{k}" for k in range(3)]

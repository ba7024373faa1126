"""Inputs derived from the given tables: papers, samples, predictions and name lists.

The tables hold prose without headings, so each document gets headings, sample codes
and measurement phrases from rules on its id and line number. Every derived row comes
from one row of a given table, so the inputs grow with the tables. The DuckDB texts
state the same rules a second time for the checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.session import dealt

RUN_ID = "run"

TITLES = ("Abstract|1 Introduction|2. Experimental|2.1 Materials and Methods|Synthesis of samples.|"
          "3 Results and Discussion|3.1 Mechanical properties|References|4 Tensile and SEM analysis|5 Conclusion")
FORMS = "film|ink|aerogel|powder|gel|solution"
PHRASES = ("FT-IR|tensile strength|was prepared|thermal conductivity|SEM||higher modulus than|freeze-dried|"
           "doped composite|viscosity of|BET surface area shrinkage more porous than|prepared from printed film|"
           "dielectric sensor substrate|XRD|density of|materials")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dealt(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def pick(text: str, index: str) -> str:
    """SQL for the index-th entry (from 0, wrapping around) of a fixed list."""
    return f"split_part('{text}', '|', cast({index} % {text.count('|') + 1} AS int) + 1)"


def _decorated(line: str, text_type: str) -> str:
    """SQL for one line with its heading, caption and sample mention."""
    heading = pick(TITLES, "(doc_id + cast(floor(i / 4.0) AS bigint))")
    mention = (f"concat(' PI/', cast(doc_id % 3 AS {text_type}), ' ', {pick(FORMS, '(doc_id + i)')}, ' ', "
               f"{pick(PHRASES, '(doc_id + i * 3)')}, ' ', cast((doc_id + i) % 7 AS {text_type}), '.5 wt%', CASE WHEN (doc_id + i) % 2 = 0 THEN 'CNC' ELSE '' END)")
    return (f"concat(CASE WHEN i % 4 = 0 AND doc_id % 13 <> 0 THEN concat('# ', {heading}, chr(10)) ELSE '' END, "
            f"CASE WHEN i % 7 = 5 THEN 'Figure 2. ' ELSE '' END, {line}, "
            f"CASE WHEN i % 3 = 1 THEN {mention} ELSE '' END)")


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(paper_no, file_name, content); built inside each row, without a shuffle."""
    text = f"array_join(transform(split(text, '\\n', -1), (line, i) -> {_decorated('line', 'string')}), chr(10))"
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("paper_no"),
        F.expr("concat('paper_', lpad(cast(doc_id AS string), 9, '0'), '.md')").alias("file_name"),
        F.expr(text).alias("content"),
    )


PAPERS_DUCK = f"""(
  SELECT doc_id AS paper_no, concat('paper_', lpad(cast(doc_id AS varchar), 9, '0'), '.md') AS file_name,
    string_agg({_decorated('line', 'varchar')}, chr(10) ORDER BY i) AS content
  FROM (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS i,
          unnest(string_split(text, chr(10))) AS line FROM documents)
  GROUP BY doc_id)"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with their hash; every tenth hash is missing."""
    return papers(spark, sf_dir).select(
        "paper_no", "file_name", "content",
        F.when(F.col("paper_no") % 10 != 0, F.md5(F.col("content").cast("binary"))).alias("md5"),
    )


RAW_DUCK = f"(SELECT *, CASE WHEN paper_no % 10 <> 0 THEN md5(content) END AS md5 FROM {PAPERS_DUCK})"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers as documents with short ids."""
    return papers(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("paper_no").cast("string")).alias("doc_id"), "file_name", "content")


DOCS_DUCK = f"(SELECT concat('d', cast(paper_no AS varchar)) AS doc_id, file_name, content FROM {PAPERS_DUCK})"


def _sample_columns(text_type: str) -> list[str]:
    return [
        f"concat('d', cast(doc_id AS {text_type})) AS doc_id",
        "k AS sample_index",
        f"concat('d', cast(doc_id AS {text_type}), '_s', cast(k AS {text_type})) AS sample_id",
        f"concat(CASE WHEN k = 2 THEN concat(cast(doc_id % 7 AS {text_type}), '.5 wt%CNC ') ELSE '' END, 'PI/', "
        f"cast(doc_id % 3 AS {text_type}), ' ', {pick(FORMS, '(doc_id + k)')}) AS name",
        f"CASE WHEN doc_id % 5 = 1 THEN 'PI' ELSE concat('PI/', cast(doc_id % 3 AS {text_type})) END AS category_code",
        "CASE WHEN k = 1 THEN 'Polyimide' END AS category_name",
        f"{pick('Film|Ink|Aerogel|Powder|Gel|Solution', '(doc_id + k)')} AS sample_form",
    ]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two samples per document."""
    pairs = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return pairs.selectExpr(*_sample_columns("string"))


SAMPLES_DUCK = f"(SELECT {', '.join(_sample_columns('varchar'))} FROM documents, (VALUES (1), (2)) v(k))"


# --- answers of the model, from rules on events and documents

def _answer_sql(json_text: str, e: str) -> str:
    """Break an answer the usual ways: fences, prose around it, cut ends, no JSON, failed calls."""
    return (f"CASE WHEN {e} % 11 = 5 THEN '' WHEN {e} % 13 = 4 THEN 'no answer possible' "
            f"WHEN {e} % 5 = 1 THEN concat('```json', chr(10), {json_text}, chr(10), '```') "
            f"WHEN {e} % 5 = 2 THEN concat('Here it is: ', {json_text}, ' Done.') "
            f"WHEN {e} % 5 = 0 THEN substr({json_text}, 1, length({json_text}) - 2) ELSE {json_text} END")


ERROR_SQL = "CASE WHEN event_id % 11 = 5 THEN 'TimeoutError: no answer' END"
VALID_EVENT = "event_id % 11 <> 5 AND event_id % 13 <> 4"


def property_rule(x: str, t: str) -> dict[str, str]:
    """Fields of a property entry as SQL on a number."""
    return {
        "category": pick("Thermal|Mechanical|mechanical ", x),
        "name": pick("modulus|mechanical properties|Tg|tensile strength", x),
        "single_number": f"CASE WHEN {x} % 4 = 2 THEN cast({x} % 50 AS {t}) END",
        "single_text": f"CASE WHEN {x} % 4 = 3 OR {x} % 8 = 0 THEN concat(cast({x} % 1000 AS {t}), ' MPa') END",
        "note": f"CASE WHEN {x} % 6 = 1 THEN 'not measured accurately' WHEN {x} % 6 = 2 THEN concat('note ', repeat('x', cast({x} % 9 AS int))) END",
        "method": f"concat('ASTM D', cast({x} % 1300 AS {t}))",
        "humidity": f"CASE WHEN {x} % 3 = 0 THEN concat(cast({x} % 60 AS {t}), '%') END",
    }


def _json_text(value: str) -> str:
    return f"coalesce('\"' || {value} || '\"', 'null')"  # null in both dialects where the value is


def property_body(t: str) -> str:
    """SQL for a whole property answer, of one or two entries."""
    def entry(x: str) -> str:
        r = property_rule(x, t)
        return (f"concat('{{\"类别\":\"', {r['category']}, '\",\"名称\":\"', {r['name']}, '\",\"缩写\":null,\"值\":{{\"单值\":', "
                f"coalesce({r['single_number']}, {_json_text(r['single_text'])}), ',\"说明\":', {_json_text(r['note'])}, "
                f"'}},\"测试条件\":{{\"方法\":\"', {r['method']}, '\"', coalesce(',\"湿度\":\"' || {r['humidity']} || '\"', ''), '}}}}')")

    return (f"concat('{{\"性质\":[', {entry('event_id')}, CASE WHEN event_id % 2 = 0 THEN concat(',', {entry('(event_id + 7)')}) "
            "ELSE '' END, ']}')")


def property_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task_id, file_order, seq, raw_text, error): one answer per event, tasks are users."""
    return _answers(spark, sf_dir, "property", property_body("string"))


def _answers(spark: SparkSession, sf_dir: str, stage: str, body: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("*", f"{body} AS body").selectExpr(
        f"concat('run__u', cast(user_id AS string), '__{stage}') AS task_id",
        "cast(event_id % 3 AS int) AS file_order", "event_id AS seq",
        f"{_answer_sql('body', 'event_id')} AS raw_text", f"{ERROR_SQL} AS error")


def char_rule(x: str, t: str) -> dict[str, str]:
    return {
        "peak_a": f"concat(cast({x} % 17 AS {t}), ' (C=O)')", "peak_b": f"concat(cast({x} % 5 AS {t}), ' (O-H)')",
        "mn": f"CASE WHEN {x} % 3 = 0 THEN cast({x} % 90 AS {t}) END",
        "mn_text": f"CASE WHEN {x} % 3 = 1 THEN concat('about ', cast({x} % 900 AS {t})) END",
        "sem": f"CASE WHEN {x} % 2 = 0 THEN concat('pores ', repeat('o', cast({x} % 11 AS int))) END",
    }


def char_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = char_rule("event_id", "string")
    body = (f"concat('{{\"表征\":{{\"红外_FTIR\":{{\"峰位_cm_1\":[\"', {r['peak_a']}, '\",\"', {r['peak_b']}, '\"]}},\"分子量_GPC_SEC\":{{\"Mn_kDa\":', "
            f"coalesce({r['mn']}, {_json_text(r['mn_text'])}), '}},\"形貌\":{{\"SEM\":', {_json_text(r['sem'])}, '}}}}}}')")
    return _answers(spark, sf_dir, "characterization", body)


def step_rule(x: str, t: str) -> dict[str, str]:
    return {
        "product": pick("PI film|pi film|PI aerogel|PAA ink", x), "mass": f"CASE WHEN {x} % 4 = 1 THEN cast({x} % 30 AS {t}) END",
        "material": pick("BPDA|bpda|DMAc", x), "amount": f"cast({x} % 40 AS {t})",
        "source": f"CASE WHEN {x} % 5 = 2 THEN concat('vendor ', cast({x} % 200 AS {t})) END",
        "procedure": pick("stir|heat", x), "atmosphere": f"CASE WHEN {x} % 3 = 1 THEN concat('N2 ', cast({x} % 7 AS {t})) END",
        "post_a": pick("Wash|wash|dry", x), "post_b": pick("filter|Dry", x),
    }


def process_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = step_rule("event_id", "string")
    body = (f"concat('{{\"工艺流程\":[{{\"产物名称\":\"', {r['product']}, '\",\"产物质量\":', coalesce({r['mass']}, 'null'), ',\"原料\":[{{\"原料名称\":\"', {r['material']}, "
            f"'\",\"质量\":{{\"单值\":', {r['amount']}, ',\"单位\":\"g\"}},\"来源\":', {_json_text(r['source'])}, '}}],\"反应条件\":[{{\"制备过程\":\"', {r['procedure']}, '\",\"反应气氛\":', "
            f"{_json_text(r['atmosphere'])}, '}}],\"后处理步骤\":[\"', {r['post_a']}, '\",\"', {r['post_b']}, '\"]}}]}}')")
    return _answers(spark, sf_dir, "process", body)


SAMPLE_NAMES = ("Polyamic acid ammonium salt solution|PI / CNC composite ink|PAA ink|PI - film ( neat )|5 wt% PI/CNC ink|"
                "PI/AuNPs film|Polyimide aerogel|pi/aunps  film|CNC ink|Polyaniline drinking gel|PI/CNC Composite Ink")
SAMPLE_CODES = "PAAS|PI/CNC|PAA||PI/CNC|PI/AuNPs|Polyimide|PI/AUNPS|CNC|PANI|PI / CNC"
SAMPLE_FORM_TEXTS = "solution|ink|ink|Film sheet||film|aerogel|film|Printing ink|gel|ink"


def sample_rule(x: str) -> dict[str, str]:
    return {
        "name": pick(SAMPLE_NAMES, x), "code": f"nullif({pick(SAMPLE_CODES, x)}, '')",
        "form": f"nullif({pick(SAMPLE_FORM_TEXTS, x)}, '')",
        "category": f"CASE WHEN {x} % 4 = 1 THEN 'PI / CNC Composite' END",
        "l1": f"CASE WHEN {x} % 9 = 2 THEN 'Heterocyclic' END", "l2": f"CASE WHEN {x} % 7 = 3 THEN 'aliphatic,  aromatic' END",
    }


def literature_rule(t: str) -> dict[str, str]:
    d = f"cast(doc_id AS {t})"
    return {
        "literature_id": (f"CASE doc_id % 5 WHEN 0 THEN concat('https://doi.org/10.1016/x.', {d}, '.') WHEN 1 THEN concat('DOI: 10.1021/y', {d}, ' )') "
                          f"WHEN 2 THEN concat('see 10.1002/z', {d}, ';') WHEN 3 THEN concat('paper ', {d}) END"),
        "keywords": pick("aerogel; Ink;ink|film|PI；CNC ; pi", "doc_id"),
    }


def n_samples_sql() -> str:
    return "cast(3 + doc_id % 4 AS int)"


def main_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two main-signal answers per document; the first call of every seventh failed."""
    s, lit = sample_rule("(doc_id + j)"), literature_rule("string")
    one = (f"concat('{{\"名称\":\"', {s['name']}, '\",\"聚合物分类编码\":', {_json_text(s['code'])}, ',\"样本形态\":', {_json_text(s['form'])}, "
           f"',\"聚合物分类名称\":', {_json_text(s['category'])}, ',\"结构特征_L1\":', {_json_text(s['l1'])}, ',\"结构特征_L2\":', {_json_text(s['l2'])}, '}}')")
    body = (f"concat('{{\"文献信息\":{{\"唯一文献标识\":', {_json_text(lit['literature_id'])}, ',\"年份\":', cast(2000 + doc_id % 25 AS string), "
            f"',\"关键词\":[\"', {lit['keywords']}, '\"]}},\"聚合物\":[', array_join(transform(sequence(1, {n_samples_sql()}), j -> {one}), ','), "
            "'],\"why\":\"answer ', cast(k AS string), '\"}')")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    failed = "k = 1 AND doc_id % 7 = 3"
    return rows.selectExpr("*", f"{body} AS body").selectExpr(
        "concat('run__d', cast(doc_id AS string), '__main_signal') AS task_id", "concat('d', cast(doc_id AS string)) AS doc_id",
        "0 AS file_order", "k AS seq",
        f"CASE WHEN {failed} THEN '' WHEN doc_id % 3 = 1 THEN concat('```json', chr(10), body, chr(10), '```') ELSE body END AS raw_text",
        f"CASE WHEN {failed} THEN 'TimeoutError: no answer' END AS error")


def response_chunks(spark: SparkSession, sf_dir: str, size: int = 24) -> DataFrame:
    """Property answers cut into chunks of a fixed length, as a token stream delivers them."""
    answers = property_answers(spark, sf_dir).where("raw_text <> ''")
    cut = f"transform(sequence(0, cast((length(raw_text) - 1) / {size} AS int)), i -> substr(raw_text, i * {size} + 1, {size}))"
    return answers.select(F.col("seq").alias("response_id"), F.posexplode(F.expr(cut)).alias("seq", "chunk"))


def conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as property answers that arrive turn by turn; some notes hold a stray bracket."""
    turns = table(spark, sf_dir, "conversations")
    last = turns.groupBy("conv_id").agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
    entry = F.expr("concat('{\"类别\":\"', role, '\",\"名称\":\"', md5(text), '\",\"值\":{\"单值\":', cast(length(text) AS string), ',\"说明\":', "
                   "CASE WHEN (conv_id + turn) % 3 = 1 THEN '\"a]\"' ELSE 'null' END, '},\"测试条件\":{}}')")
    chunk = F.concat(F.when(F.col("turn") == F.col("first"), '{"性质":[').otherwise(","), entry, F.when(F.col("turn") == F.col("last"), "]}").otherwise(""))
    return turns.join(last, "conv_id").select(F.col("conv_id").alias("response_id"), F.col("turn").alias("seq"), chunk.alias("chunk"))


# --- name lists

def pair_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """File names of both sides: equal, slightly different and unmatched ones."""
    hashed = table(spark, sf_dir, "documents").selectExpr("doc_id", "md5(concat(cast(doc_id AS string), text)) AS h")
    left = hashed.selectExpr("concat('Paper_', substr(h, 1, 20), '.md') AS name")
    right = hashed.where("doc_id % 5 <> 0").selectExpr(
        "concat('paper-', CASE WHEN doc_id % 3 = 1 THEN concat(substr(h, 1, 17), '_x') ELSE substr(h, 1, 20) END, '_content_list.json') AS name")
    return left, right


PAIR_DUCK = """
hashed AS (SELECT doc_id, md5(concat(cast(doc_id AS varchar), text)) AS h FROM documents),
lefts AS (SELECT concat('Paper_', substr(h, 1, 20), '.md') AS name FROM hashed),
rights AS (SELECT concat('paper-', CASE WHEN doc_id % 3 = 1 THEN concat(substr(h, 1, 17), '_x') ELSE substr(h, 1, 20) END, '_content_list.json') AS name FROM hashed WHERE doc_id % 5 <> 0)"""

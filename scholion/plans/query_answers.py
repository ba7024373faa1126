"""Checked queries on the model step, post-processing, final merge and pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.functions.arrays import let
from scholion.operators import answers, entities, final, merge, normalize, pairing, predict, stats, validate
from scholion.plans import derived, query_routing, query_sections
from scholion.session import cut_lineage
from scholion.plans.query_sections import SECTION_CTES, ROLE_FLAGS, TAGGED, sections, sql_list

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def parsed(spark: SparkSession, sf: str, route: str) -> DataFrame:
    make = {"main": derived.main_answers, "char": derived.char_answers, "prop": derived.property_answers,
            "proc": derived.process_answers}[route]
    return answers.parse_responses(make(spark, sf), entities.ROUTE_RESULT[route])


def stored(spark: SparkSession, sf: str, route: str) -> DataFrame:
    """Parsed answers as the model step leaves them: written once, read by later steps."""
    return cut_lineage(parsed(spark, sf, route))


def main_tasks(spark: SparkSession, sf: str) -> DataFrame:
    from scholion.operators.context import build_main_signal_tasks

    return build_main_signal_tasks(sections(spark, sf))


MAIN_OK = "NOT (k = 1 AND doc_id % 7 = 3)"
EARLIER = "doc_id % 4 = 1"
TASKS_CTE = f"{SECTION_CTES},\n{ROLE_FLAGS},{TAGGED}"


def earlier_answers(spark: SparkSession, sf: str) -> DataFrame:
    """First answers of a quarter of the documents, as an earlier run left them."""
    rows = parsed(spark, sf, "main").where("seq = 1")
    return rows.where(F.regexp_extract("doc_id", r"(\d+)", 1).cast("long") % 4 == 1)


@query("pending_tasks", f"""WITH {TASKS_CTE} SELECT doc_id, concat('run__', doc_id, '__main_signal') AS task_id FROM tagged
WHERE NOT (cast(substr(doc_id, 2) AS bigint) % 4 = 1 AND cast(substr(doc_id, 2) AS bigint) % 7 <> 3)""")
def _(spark, sf):
    return predict.pending_tasks(main_tasks(spark, sf), earlier_answers(spark, sf)).select("doc_id", "task_id")


@query("limit_pending", f"""WITH {TASKS_CTE} SELECT concat('run__', doc_id, '__main_signal') AS task_id FROM tagged
WHERE NOT (cast(substr(doc_id, 2) AS bigint) % 4 = 1 AND cast(substr(doc_id, 2) AS bigint) % 7 <> 3) ORDER BY task_id LIMIT 25""")
def _(spark, sf):
    return predict.limit_pending(predict.pending_tasks(main_tasks(spark, sf), earlier_answers(spark, sf)), 25).select("task_id")


TEMPLATE = "<System>\nExtract records. Schema: {schema_define}\n</System>\n<user>\nPaper {doc_id}, reply as {{\"why\": ..}}:\n{text}\n</user>"


@query("render_prompts", f"""WITH {TASKS_CTE} SELECT doc_id, 'system' AS role, 'Extract records. Schema: S' AS content FROM tagged
UNION ALL SELECT doc_id, 'user', concat('Paper ', doc_id, ', reply as {{"why": ..}}:', chr(10), text) FROM tagged""")
def _(spark, sf):
    return predict.render_prompts(main_tasks(spark, sf), TEMPLATE, {"schema_define": "S"}).select(
        "doc_id", F.explode("messages").alias("m")).select("doc_id", "m.role", "m.content")


@query("check_task_inputs", "SELECT event_id, 'event_type|unused' AS extra_inputs FROM events WHERE event_id % 3 = 0")
def _(spark, sf):
    rows = derived.table(spark, sf, "events").select("event_id", F.expr(
        "CASE WHEN event_id % 3 = 0 THEN map('text', props, 'event_type', event_type, 'unused', '1') ELSE map('text', props) END").alias("inputs"))
    return predict.check_task_inputs(rows, ["text"]).select("event_id", F.array_join("extra_inputs", "|").alias("extra_inputs"))


def echo_model(text: str) -> str:
    """Stand-in for a model: fails on texts with results, otherwise answers with their length."""
    if "[RESULTS]" in text:
        raise TimeoutError("no answer")
    return '{"文献信息":{},"聚合物":[],"why":"' + str(len(text)) + '"}'


PREDICTED = f"""WITH {TASKS_CTE} SELECT doc_id, CASE WHEN contains(text, '[RESULTS]') THEN 'TimeoutError: no answer' END AS error,
  CASE WHEN NOT contains(text, '[RESULTS]') THEN cast(len(text) AS varchar) END AS why FROM tagged"""


def predicted(spark, sf) -> DataFrame:
    called = predict.predict(main_tasks(spark, sf).select("run_id", "doc_id", "task_id", "text"), echo_model, 20, "main_signal", "echo")
    return answers.parse_responses(called, entities.MAIN_SIGNAL)


@query("predict", PREDICTED)
def _(spark, sf):
    return predicted(spark, sf).select("doc_id", "error", F.col("parse.why").alias("why"))


@query("predict_stats", f"""WITH {TASKS_CTE}, p AS (SELECT contains(text, '[RESULTS]') AS failed, cast(substr(doc_id, 2) AS bigint) AS d FROM tagged)
SELECT 'total_task_count' AS metric, count(*) AS value FROM p UNION ALL SELECT 'existing_done_count', count(*) FILTER (d % 4 = 1 AND d % 7 <> 3) FROM p
UNION ALL SELECT 'todo_count', count(*) FILTER (NOT (d % 4 = 1 AND d % 7 <> 3)) FROM p UNION ALL SELECT 'success_count', count(*) FILTER (NOT failed) FROM p
UNION ALL SELECT 'parse_error_count', count(*) FILTER (failed) FROM p UNION ALL SELECT 'invoke_error_count', 0""")
def _(spark, sf):
    return stats.predict_stats(main_tasks(spark, sf), earlier_answers(spark, sf), predicted(spark, sf))


# --- parsing

P = derived.property_rule("x", "varchar")
ENTRIES = f"""
entries AS (SELECT user_id, concat('run__u', cast(user_id AS varchar), '__property') AS task_id, event_id % 3 AS file_order, event_id AS seq, j,
    trim({P['category']}) AS category, {P['name']} AS name, {P['single_number']} AS num, {P['single_text']} AS txt, {P['note']} AS note, {P['method']} AS method, {P['humidity']} AS humidity
  FROM (SELECT *, event_id AS x, 0 AS j FROM events UNION ALL SELECT *, event_id + 7, 1 FROM events WHERE event_id % 2 = 0) WHERE {derived.VALID_EVENT})"""


@query("parse_responses", f"""WITH {ENTRIES.strip()} SELECT seq, j, category, name, coalesce(num, txt) AS single, num IS NOT NULL AS is_number, trim(note) AS note, method, humidity FROM entries""")
def _(spark, sf):
    e = F.col("e")
    return parsed(spark, sf, "prop").where("parse IS NOT NULL").select("seq", F.posexplode("parse.properties").alias("j", "e")).select(
        "seq", "j", e["category"].alias("category"), e["name"].alias("name"), e["value"]["single"]["text"].alias("single"),
        F.coalesce(e["value"]["single"]["is_number"], F.lit(False)).alias("is_number"), e["value"]["note"].alias("note"),
        e["conditions"]["method"].alias("method"), F.try_element_at(e["conditions"]["extra"], F.lit("湿度")).alias("humidity"))


@query("response_errors", f"""SELECT event_id AS seq, CASE WHEN event_id % 11 = 5 THEN 'TimeoutError: no answer' WHEN event_id % 13 = 4 THEN '{answers.NO_JSON}' END AS error FROM events""")
def _(spark, sf):
    return parsed(spark, sf, "char").select("seq", "error")


@query("prediction_status", f"""SELECT CASE WHEN {derived.VALID_EVENT} THEN 'ok' ELSE 'parse_error' END AS status, count(*) AS n FROM events GROUP BY ALL""")
def _(spark, sf):
    return answers.prediction_status(parsed(spark, sf, "proc"))


def _emissions(made: DataFrame) -> DataFrame:
    """All emitted readings, their entries in one text."""
    entry = lambda p: F.concat_ws("|", p["category"], p["name"], p["value"]["single"]["text"], p["value"]["note"], p["conditions"]["method"],
                                  F.try_element_at(p["conditions"]["extra"], F.lit("湿度")))
    return made.select("response_id", "seq", "is_final", F.array_join(F.transform("parse.properties", entry), ";").alias("entries"))


# an answer can be read from the chunk with its closing bracket on; a cut one, or one without JSON, at its end
@query("assemble_chunks", f"""WITH {ENTRIES.strip()},
texts AS (SELECT event_id, {derived._answer_sql('body', 'event_id')} AS t FROM (SELECT event_id, {derived.property_body('varchar')} AS body FROM events) WHERE event_id % 11 <> 5),
read AS (SELECT seq, string_agg(concat_ws('|', category, name, coalesce(num, txt), trim(note), method, humidity), ';' ORDER BY j) AS entries FROM entries GROUP BY seq),
placed AS (SELECT event_id, (len(t) - 1) // 24 AS last, CASE WHEN strpos(t, ']') > 0 THEN (strpos(t, ']') - 1) // 24 ELSE (len(t) - 1) // 24 END AS place FROM texts)
SELECT event_id AS response_id, place AS seq, place = last AS is_final, entries FROM placed LEFT JOIN read ON read.seq = event_id""")
def _(spark, sf):
    return _emissions(answers.assemble_chunks(derived.response_chunks(spark, sf), entities.PROP_RESULT))


@query("assemble_conversations", """WITH t AS (SELECT conv_id, turn, (conv_id + turn) % 3 = 1 AS stray, turn = max(turn) OVER (PARTITION BY conv_id) AS is_final,
    concat_ws('|', role, md5(text), cast(len(text) AS varchar), CASE WHEN (conv_id + turn) % 3 = 1 THEN 'a]' END) AS entry FROM conversations),
r AS (SELECT *, bool_or(stray) OVER w AS balanced, string_agg(entry, ';') OVER w AS entries FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id AS response_id, turn AS seq, is_final, entries FROM r WHERE balanced OR is_final""")
def _(spark, sf):
    return _emissions(answers.assemble_chunks(derived.conversation_chunks(spark, sf), entities.PROP_RESULT))


@query("running_bracket_counts", """
WITH c AS (SELECT event_id AS response_id, t, unnest(range(0, cast(ceil(len(t) / 5.0) AS bigint))) AS seq FROM (SELECT event_id, concat('{"k":[', props, ',{}', ']}') AS t FROM events)),
k AS (SELECT response_id, seq, substr(t, cast(seq * 5 + 1 AS bigint), 5) AS chunk FROM c)
SELECT response_id, seq, sum(len(chunk) - len(replace(chunk, '{', ''))) OVER w AS opens, sum(len(chunk) - len(replace(chunk, '}', ''))) OVER w AS closes FROM k
WINDOW w AS (PARTITION BY response_id ORDER BY seq)""")
def _(spark, sf):
    text = F.concat(F.lit('{"k":['), "props", F.lit(",{}]}"))
    chunks = derived.table(spark, sf, "events").select(F.col("event_id").alias("response_id"), text.alias("t")).select(
        "response_id", F.posexplode(F.expr("transform(sequence(0, cast((length(t) - 1) / 5 AS int)), i -> substr(t, i * 5 + 1, 5))")).alias("seq", "chunk"))
    return answers.running_counts(chunks, "response_id", "seq", {
        "opens": F.length("chunk") - F.length(F.replace("chunk", F.lit("{"), F.lit(""))),
        "closes": F.length("chunk") - F.length(F.replace("chunk", F.lit("}"), F.lit("")))}).drop("chunk")


@query("recover_raw_text", f"""SELECT event_id AS seq, {derived.VALID_EVENT} AND event_id % 5 IN (3, 4) AS recovered FROM events""")
def _(spark, sf):
    failed = parsed(spark, sf, "proc").withColumn("error", F.lit("lost")).withColumn("parse", F.when(F.lit(False), F.col("parse")))
    return answers.recover_raw_text(failed, entities.PROC_RESULT).select("seq", F.col("parse").isNotNull().alias("recovered"))


@query("pending_samples_v1", """WITH m AS (SELECT doc_id, unnest(range(1, cast(3 + doc_id % 3 AS bigint))) AS k FROM documents)
SELECT concat('f', doc_id, '.md') AS file_name, concat('Z', k) AS material_id, len(text) AS n_chars FROM m JOIN documents USING (doc_id) WHERE NOT (doc_id % 2 = 0 AND k = 1)""")
def _(spark, sf):
    docs = derived.table(spark, sf, "documents").withColumn("file_name", F.expr("concat('f', doc_id, '.md')"))
    main = docs.selectExpr("file_name", "transform(sequence(1, cast(2 + doc_id % 3 AS int)), k -> named_struct('id', concat('Z', k), 'aliases', array(concat('z', k)))) AS material_ids")
    done = docs.selectExpr("doc_id", "file_name", "explode(array(1, 2)) AS k").selectExpr(
        "file_name", "concat('Z', k) AS material_id", "named_struct('error', CASE WHEN doc_id % 2 = 1 OR k = 2 THEN 'failed' END) AS syn_result")
    texts = docs.select("file_name", F.col("text").alias("specific_section"))
    return predict.pending_samples_v1(main, texts, done, "specific_section").select(
        "file_name", "material_id", F.length("paper_info").alias("n_chars"))


# --- main signal post-processing

S = derived.sample_rule("(doc_id + j)")
LIT = derived.literature_rule("varchar")
N = normalize


def case_table(value: str, table: dict[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {value} = '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def any_of(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def compact(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({x}, '\s+', ' ', 'g'), '\s*/\s*', '/', 'g'), '\s*-\s*', '-', 'g'))"


FORM_CASE = lambda t: "CASE " + " ".join(f"WHEN contains({t}, '{w}') THEN '{f}'" for w, f in N.SAMPLE_FORMS) + " END"
PREFIX = rf"""CASE doc_id % 5 WHEN 0 THEN concat('doi:10.1016/x.', doc_id) WHEN 1 THEN concat('doi:10.1021/y', doc_id) WHEN 2 THEN concat('doi:10.1002/z', doc_id) WHEN 3 THEN concat('paper', doc_id) END"""
SAMPLE_CTES = rf"""
given AS (SELECT doc_id, j, {S['name']} AS name0, {S['code']} AS code0, {S['form']} AS form0, {S['category']} AS cat0, {S['l1']} AS l10, {S['l2']} AS l20
  FROM (SELECT doc_id, unnest(range(1, {derived.n_samples_sql()} + 1)) AS j FROM documents)),
coded AS (SELECT *, coalesce({case_table(f"upper({compact('code0')})", N.CODE_ALIASES)}, {compact('code0')}) AS code,
    regexp_replace(regexp_replace({compact('name0')}, '\(\s+', '(', 'g'), '\s+\)', ')', 'g') AS name, lower(concat_ws(' ', name0, cat0, code0)) AS t0 FROM given),
norm AS (SELECT doc_id, j, name, code, coalesce({compact('cat0')}, {case_table('code', N.CODE_NAMES)}) AS category_name,
    coalesce({FORM_CASE('lower(form0)')}, form0, {FORM_CASE('lower(name)')}) AS form,
    coalesce(lower(l10), CASE WHEN {any_of('t0', N.CONJUGATED)} THEN 'conjugated_linear' WHEN {any_of('t0', N.HETEROCYCLIC)} THEN
      CASE WHEN {any_of('t0', N.COMPOSITE)} OR {any_of('t0', N.ALIPHATIC)} THEN 'partially_heterocyclic' ELSE 'heterocyclic' END
      WHEN {any_of('t0', N.PRECURSOR)} THEN CASE WHEN {any_of('t0', N.MODIFIED)} THEN 'modified_linear' ELSE 'unmodified_linear' END END) AS l1,
    coalesce(CASE WHEN l20 IS NOT NULL THEN 'aromatic, aliphatic' END, CASE WHEN {any_of('t0', N.AROMATIC)} AND {any_of('t0', N.ALIPHATIC)} THEN 'aromatic, aliphatic'
      WHEN {any_of('t0', N.AROMATIC)} THEN 'aromatic' WHEN {any_of('t0', N.ALIPHATIC)} THEN 'aliphatic' END) AS l2 FROM coded),
texts AS (SELECT *, lower(concat_ws(' ', name, category_name, code)) AS t, lower(coalesce(form, '')) AS f FROM norm),
comps AS (SELECT *, CASE WHEN code IS NOT NULL THEN list_transform(string_split(code, '/'), lambda p: upper(p)) ELSE
    list_filter([{", ".join(f"CASE WHEN {any_of('t', ws)} THEN '{c}' END" for c, ws in N.INK_COMPONENTS.items())}], lambda x: x IS NOT NULL) END AS parts FROM texts),
judged AS (SELECT *, f NOT IN ('solution', 'gel') AS solid,
    f IN ('solution', 'gel') AND {any_of('t', N.LIQUID_FAMILY)} AND NOT regexp_matches(t, '\d') AND NOT {any_of('t', N.COMPOSITE)}
      AND len(list_filter(regexp_extract_all(t, '[a-z0-9]+'), lambda w: len(w) >= 3 AND w NOT IN ({sql_list(N.LIQUID_TOKENS)}))) = 0 AS generic_liquid,
    f = 'ink' AND (len(list_distinct(parts)) >= 2 OR {any_of('t', N.COMPOSITE)}) AS composite FROM comps),
flags AS (SELECT *, bool_or(solid) OVER d AS any_solid, count(*) FILTER (composite) OVER d AS n_composites, list_distinct(flatten(list(parts) FILTER (composite) OVER d)) AS known FROM judged WINDOW d AS (PARTITION BY doc_id)),
inks AS (SELECT *, any_solid AND generic_liquid AS drop_liquid, n_composites >= 2 AND f = 'ink' AND NOT composite AND len(list_distinct(parts)) = 1 AND list_contains(known, parts[1])
      AND NOT {any_of('t', N.INK_CONTROLS)} AND len(list_filter(regexp_extract_all(t, '[a-z0-9]+'), lambda w: len(w) >= 3 AND w NOT IN ({sql_list(N.INK_TOKENS)}) AND NOT regexp_full_match(w, '\d+(wt)?'))) = 0 AS drop_ink FROM flags)"""


def normalized(spark, sf) -> DataFrame:
    return normalize.normalize_documents(normalize.first_good_prediction(parsed(spark, sf, "main")))


@query("first_good_prediction", """SELECT concat('run__d', doc_id, '__main_signal') AS task_id, CASE WHEN doc_id % 7 = 3 THEN 'answer 2' ELSE 'answer 1' END AS why FROM documents""")
def _(spark, sf):
    return normalize.first_good_prediction(parsed(spark, sf, "main")).select("task_id", F.col("parse.why").alias("why"))


@query("normalize_literature", rf"""SELECT concat('d', doc_id) AS doc_id, {PREFIX} AS literature_id, cast(2000 + doc_id % 25 AS varchar) AS year,
  CASE doc_id % 3 WHEN 0 THEN 'aerogel|Ink' WHEN 1 THEN 'film' ELSE 'PI|CNC' END AS keywords FROM documents""")
def _(spark, sf):
    return normalized(spark, sf).select("doc_id", "literature.literature_id", "literature.year", F.array_join("literature.keywords", "|").alias("keywords"))


@query("normalize_samples", f"WITH {SAMPLE_CTES.strip()} SELECT concat('d', doc_id) AS doc_id, j, name, code, category_name, form, l1, l2 FROM norm")
def _(spark, sf):
    first = normalize.first_good_prediction(parsed(spark, sf, "main"))
    return first.select("doc_id", F.posexplode(normalize.normalize_samples(F.col("parse.samples"))).alias("j", "s")).select(
        "doc_id", (F.col("j") + 1).alias("j"), "s.name", F.col("s.category_code").alias("code"), "s.category_name",
        F.col("s.sample_form").alias("form"), F.col("s.structure_l1").alias("l1"), F.col("s.structure_l2").alias("l2"))


def _dropped(spark, sf, rule) -> DataFrame:
    first = normalize.first_good_prediction(parsed(spark, sf, "main"))
    return first.select("doc_id", let(normalize.normalize_samples(F.col("parse.samples")), lambda xs: F.struct(
        F.size(xs).alias("before"), F.size(rule(xs)).alias("after"))).alias("n")).select("doc_id", "n.*")


@query("infer_structure", f"WITH {SAMPLE_CTES.strip()} SELECT coalesce(l1, 'none') AS l1, coalesce(l2, 'none') AS l2, count(*) AS n FROM norm GROUP BY ALL")
def _(spark, sf):
    first = normalize.first_good_prediction(parsed(spark, sf, "main"))
    return first.select(F.explode(normalize.normalize_samples(F.col("parse.samples"))).alias("s")).groupBy(
        F.coalesce("s.structure_l1", F.lit("none")).alias("l1"), F.coalesce("s.structure_l2", F.lit("none")).alias("l2")).agg(F.count(F.lit(1)).alias("n"))


@query("drop_generic_process_liquids", f"""WITH {SAMPLE_CTES.strip()} SELECT concat('d', doc_id) AS doc_id, count(*) AS "before", count(*) FILTER (NOT drop_liquid) AS "after" FROM inks GROUP BY doc_id""")
def _(spark, sf):
    return _dropped(spark, sf, normalize.drop_generic_process_liquids)


@query("drop_generic_inks", f"""WITH {SAMPLE_CTES.strip()} SELECT concat('d', doc_id) AS doc_id, count(*) AS "before", count(*) FILTER (NOT drop_ink) AS "after" FROM inks GROUP BY doc_id""")
def _(spark, sf):
    return _dropped(spark, sf, normalize.drop_generic_inks)


FINAL_SAMPLES = rf"""{SAMPLE_CTES},
keyed AS (SELECT *, concat_ws(chr(31), regexp_replace(lower(name), '[^a-z0-9]+', '', 'g'), coalesce(code, ''), coalesce(form, '')) AS key,
    (category_name IS NOT NULL)::int + (l1 IS NOT NULL)::int + (l2 IS NOT NULL)::int AS score FROM inks WHERE NOT drop_liquid AND NOT drop_ink),
pairs AS (SELECT *, row_number() OVER (PARTITION BY doc_id, key ORDER BY j) AS k, count(*) OVER (PARTITION BY doc_id, key) AS copies FROM keyed),
merged AS (SELECT a.doc_id, a.j, a.key, CASE WHEN coalesce(b.score, -1) > a.score THEN b.name ELSE a.name END AS name, a.code, a.form,
    CASE WHEN coalesce(b.score, -1) > a.score THEN coalesce(b.category_name, a.category_name) ELSE coalesce(a.category_name, b.category_name) END AS category_name,
    CASE WHEN coalesce(b.score, -1) > a.score THEN coalesce(b.l1, a.l1) ELSE coalesce(a.l1, b.l1) END AS l1,
    CASE WHEN coalesce(b.score, -1) > a.score THEN coalesce(b.l2, a.l2) ELSE coalesce(a.l2, b.l2) END AS l2, a.copies
  FROM pairs a LEFT JOIN pairs b ON b.doc_id = a.doc_id AND b.key = a.key AND b.k = 2 WHERE a.k = 1),
numbered AS (SELECT *, concat(coalesce({PREFIX}, concat('d', doc_id)), '_', name, '_', lpad(cast(row_number() OVER (PARTITION BY doc_id, lower(name) ORDER BY j) AS varchar), 2, '0')) AS sample_id,
    row_number() OVER (PARTITION BY doc_id ORDER BY j) AS pos FROM merged)"""


@query("dedupe_samples", f"WITH {FINAL_SAMPLES.strip()} SELECT concat('d', doc_id) AS doc_id, pos, name, code, form, category_name, l1, l2 FROM numbered")
def _(spark, sf):
    return normalized(spark, sf).select("doc_id", F.posexplode("samples").alias("pos", "s")).select(
        "doc_id", (F.col("pos") + 1).alias("pos"), "s.name", F.col("s.category_code").alias("code"), F.col("s.sample_form").alias("form"),
        "s.category_name", F.col("s.structure_l1").alias("l1"), F.col("s.structure_l2").alias("l2"))


@query("number_identities", f"WITH {FINAL_SAMPLES.strip()} SELECT concat('d', doc_id) AS doc_id, pos, sample_id FROM numbered")
def _(spark, sf):
    return normalized(spark, sf).select("doc_id", F.posexplode("samples").alias("pos", "s")).select(
        "doc_id", (F.col("pos") + 1).alias("pos"), "s.sample_id")


# --- merging answers

def longest(x: str) -> str:
    return f"arg_min({x}, (-len({x}), file_order, seq, j)) FILTER ({x} IS NOT NULL)"


MERGED_PROPS = f"""{ENTRIES},
counted AS (SELECT *, count(DISTINCT seq) OVER (PARTITION BY task_id) AS n_records FROM entries),
merged AS (SELECT task_id, n_records, min((file_order, seq, j)) AS first_ord, {longest('category')} AS category, {longest('name')} AS name,
    CASE WHEN arg_min(num IS NOT NULL, (file_order, seq, j)) FILTER (coalesce(num, txt) IS NOT NULL) THEN arg_min(num, (file_order, seq, j)) FILTER (num IS NOT NULL) ELSE {longest('txt')} END AS single,
    {longest('trim(note)')} AS note, {longest('method')} AS method, {longest('humidity')} AS humidity
  FROM counted GROUP BY task_id, n_records, lower(category), lower(name), CASE WHEN n_records = 1 THEN j END),
weak AS (SELECT *, n_records > 1 AND single IS NULL AND (coalesce(contains(note, 'not measured accurately'), false) OR (name = 'mechanical properties'
    AND bool_or(name <> 'mechanical properties') OVER (PARTITION BY task_id, lower(category)))) AS drop FROM merged)"""


def _property_rows(df: DataFrame, *keys: str) -> DataFrame:
    e = F.col("e")
    return df.select(*keys, F.posexplode("payload").alias("pos", "e")).select(
        *keys, "pos", e["category"].alias("category"), e["name"].alias("name"), e["value"]["single"]["text"].alias("single"),
        e["value"]["note"].alias("note"), e["conditions"]["method"].alias("method"),
        F.try_element_at(e["conditions"]["extra"], F.lit("湿度")).alias("humidity"))


@query("merge_properties", f"""WITH {MERGED_PROPS.strip()} SELECT task_id, row_number() OVER (PARTITION BY task_id ORDER BY first_ord) - 1 AS pos, category, name, single, note, method, humidity FROM weak WHERE NOT drop""")
def _(spark, sf):
    return _property_rows(merge.merge_predictions(stored(spark, sf, "prop"), "prop"), "task_id")


@query("drop_weak_properties", f"""WITH {MERGED_PROPS.strip()} SELECT task_id, count(*) AS n_merged, count(*) FILTER (NOT drop) AS n_kept FROM weak GROUP BY task_id""")
def _(spark, sf):
    rows = merge.valid_predictions(stored(spark, sf, "prop"))
    entry = F.struct(*[F.col(f"p.{n}").alias(n) for n in ("category", "name", "value")])
    keyed = rows.select("task_id", F.explode("parse.properties").alias("p")).groupBy(
        "task_id", F.lower("p.category").alias("c"), F.lower("p.name").alias("n")).agg(
        F.first("p.category").alias("category"), F.first("p.name").alias("name"),
        F.max(F.coalesce("p.value.single.text", "p.value.note")).alias("t"),
        F.max("p.value.single.text").alias("s"), F.max_by("p.value.note", F.length("p.value.note")).alias("note"))
    union = F.when(F.col("s").isNotNull(), F.struct(F.col("s").alias("text"), F.lit(False).alias("is_number")))
    none = F.lit(None).cast("struct<text:string,is_number:boolean>")
    value = F.struct(union.alias("single"), none.alias("minimum"), none.alias("maximum"), none.alias("error"), F.col("note").alias("note"))
    listed = keyed.groupBy("task_id").agg(F.collect_list(F.struct("category", "name", value.alias("value"))).alias("es"))
    return listed.select("task_id", F.size("es").alias("n_merged"), F.size(merge.drop_weak_properties(F.col("es"))).alias("n_kept"))


C = derived.char_rule("event_id", "varchar")
CHAR_ROWS = f"""
crows AS (SELECT user_id, concat('run__u', user_id, '__characterization') AS task_id, event_id % 3 AS file_order, event_id AS seq, 0 AS j, {C['peak_a']} AS a, {C['peak_b']} AS b,
  {C['mn']} AS mn, {C['mn_text']} AS mn_text, trim({C['sem']}) AS sem FROM events WHERE {derived.VALID_EVENT}),
peaks AS (SELECT task_id, p, min((file_order, seq, k)) AS ao FROM (SELECT task_id, file_order, seq, 0 AS k, a AS p FROM crows UNION ALL SELECT task_id, file_order, seq, 1, b FROM crows) GROUP BY ALL),
peak_lists AS (SELECT task_id, string_agg(p, '|' ORDER BY ao) AS peaks FROM peaks GROUP BY task_id),
scalars AS (SELECT task_id, CASE WHEN arg_min(mn IS NOT NULL, (file_order, seq)) FILTER (coalesce(mn, mn_text) IS NOT NULL) THEN arg_min(mn, (file_order, seq)) FILTER (mn IS NOT NULL) ELSE {longest('mn_text')} END AS mn,
  {longest('sem')} AS sem FROM crows GROUP BY task_id)"""


@query("merge_characterizations", f"WITH {CHAR_ROWS.strip()} SELECT task_id, peaks, mn, sem FROM peak_lists JOIN scalars USING (task_id)")
def _(spark, sf):
    return merge.merge_predictions(stored(spark, sf, "char"), "char").select(
        "task_id", F.array_join("payload.ftir.peaks_cm_1", "|").alias("peaks"), F.col("payload.gpc_sec.mn_kda.text").alias("mn"),
        F.col("payload.morphology.sem").alias("sem"))


ST = derived.step_rule("event_id", "varchar")
STEP_ROWS = f"""
srows AS (SELECT concat('run__u', user_id, '__process') AS task_id, event_id % 3 AS file_order, event_id AS seq, 0 AS j, {ST['product']} AS product, {ST['mass']} AS mass, {ST['material']} AS material,
  {ST['amount']} AS amount, {ST['source']} AS source, {ST['procedure']} AS proc, {ST['atmosphere']} AS atmosphere, {ST['post_a']} AS post_a, {ST['post_b']} AS post_b FROM events WHERE {derived.VALID_EVENT}),
steps AS (SELECT task_id, lower(product) AS k, min((file_order, seq)) AS first_ord, arg_min(product, (file_order, seq)) AS product, cast(arg_min(mass, (file_order, seq)) FILTER (mass IS NOT NULL) AS double) AS mass FROM srows GROUP BY ALL),
mats AS (SELECT task_id, lower(product) AS k, lower(material) AS m, arg_min(material, (file_order, seq)) AS material, arg_min(amount, (file_order, seq)) AS amount, {longest('source')} AS source, min((file_order, seq)) AS ao FROM srows GROUP BY ALL),
mat_lists AS (SELECT task_id, k, string_agg(concat_ws(':', material, amount, source), '|' ORDER BY ao) AS materials FROM mats GROUP BY ALL),
conds AS (SELECT task_id, lower(product) AS k, proc, {longest('atmosphere')} AS atmosphere, min((file_order, seq)) AS ao FROM srows GROUP BY ALL),
cond_lists AS (SELECT task_id, k, string_agg(concat_ws(':', proc, atmosphere), '|' ORDER BY ao) AS conditions FROM conds GROUP BY ALL),
posts AS (SELECT *, (file_order, seq) = max((file_order, seq)) OVER (PARTITION BY task_id, k) AS is_last FROM
  (SELECT task_id, lower(product) AS k, file_order, seq, 0 AS i, post_a AS v FROM srows UNION ALL SELECT task_id, lower(product), file_order, seq, 1, post_b FROM srows)),
post_first AS (SELECT task_id, k, is_last, lower(v) AS lv, arg_min(v, (file_order, seq, i)) AS v, min((file_order, seq, i)) AS ao FROM posts GROUP BY ALL),
post_lists AS (SELECT task_id, k, string_agg(v, '|' ORDER BY ao) AS post_processing FROM (SELECT task_id, k, v, min(ao) AS ao FROM post_first GROUP BY ALL) GROUP BY ALL)"""


@query("merge_process_steps", f"""WITH {STEP_ROWS.strip()} SELECT task_id, row_number() OVER (PARTITION BY task_id ORDER BY first_ord) - 1 AS pos, product, mass, materials, conditions, post_processing
FROM steps JOIN mat_lists USING (task_id, k) JOIN cond_lists USING (task_id, k) JOIN post_lists USING (task_id, k)""")
def _(spark, sf):
    s = F.col("s")
    return merge.merge_predictions(stored(spark, sf, "proc"), "proc").select("task_id", F.posexplode("payload").alias("pos", "s")).select(
        "task_id", "pos", s["product_name"].alias("product"), s["product_mass"].alias("mass"),
        F.array_join(F.transform(s["materials"], lambda m: F.concat_ws(":", m["name"], m["mass"]["single"]["text"], m["source"])), "|").alias("materials"),
        F.array_join(F.transform(s["conditions"], lambda c: F.concat_ws(":", c["procedure"], c["atmosphere"])), "|").alias("conditions"),
        F.array_join(s["post_processing"], "|").alias("post_processing"))


@query("after_stage_counts", f"""WITH good AS (SELECT user_id, count(*) AS n FROM events WHERE {derived.VALID_EVENT} GROUP BY ALL), t AS (SELECT DISTINCT user_id FROM events UNION SELECT -1)
SELECT 'total_task_count' AS metric, count(*) AS value FROM t UNION ALL SELECT 'good_predict_record_count', sum(n) FROM good UNION ALL SELECT 'matched_task_count', count(*) FROM t JOIN good USING (user_id)
UNION ALL SELECT 'merged_duplicate_count', sum(n - 1) FROM good UNION ALL SELECT 'missing_predict_count', count(*) FROM t WHERE user_id NOT IN (SELECT user_id FROM good)""")
def _(spark, sf):
    preds = stored(spark, sf, "char")
    users = derived.table(spark, sf, "events").select(F.explode(F.array("user_id", F.lit(-1))).alias("u")).distinct()
    tasks = users.select(F.format_string("run__u%d__characterization", "u").alias("task_id"))
    return merge.after_counts(tasks, preds)


@query("deep_merge_pairs", f"""WITH {CHAR_ROWS.strip()}, p AS (SELECT a.seq, a.a AS a1, a.b AS b1, b.a AS a2, b.b AS b2, a.mn AS n1, a.mn_text AS t1, b.mn AS n2, b.mn_text AS t2, a.sem AS s1, b.sem AS s2 FROM crows a JOIN crows b ON b.seq = a.seq + 1)
SELECT seq, array_to_string(list_filter([a1, b1, CASE WHEN a2 NOT IN (a1, b1) THEN a2 END, CASE WHEN b2 NOT IN (a1, b1, a2) THEN b2 END], lambda x: x IS NOT NULL), '|') AS peaks,
  CASE WHEN n1 IS NOT NULL THEN n1 WHEN t1 IS NULL THEN coalesce(n2, t2) WHEN t2 IS NOT NULL AND len(t2) > len(t1) THEN t2 ELSE t1 END AS mn,
  CASE WHEN s1 IS NULL THEN s2 WHEN s2 IS NULL OR len(s1) >= len(s2) THEN s1 ELSE s2 END AS sem FROM p""")
def _(spark, sf):
    rows = merge.valid_predictions(stored(spark, sf, "char")).select("seq", F.col("parse.characterization").alias("c"))
    pairs = rows.join(rows.select((F.col("seq") - 1).alias("seq"), F.col("c").alias("d")), "seq")
    merged = pairs.withColumn("m", merge.prune_empty(merge.deep_merge(F.col("c"), F.col("d"), entities.CHARACTERIZATION), entities.CHARACTERIZATION))
    return merged.select("seq", F.array_join("m.ftir.peaks_cm_1", "|").alias("peaks"), F.col("m.gpc_sec.mn_kda.text").alias("mn"), F.col("m.morphology.sem").alias("sem"))


@query("prune_empty", f"""WITH {CHAR_ROWS.strip()} SELECT seq, concat('{{"ftir":{{"peaks_cm_1":["', a, '","', b, '"]}}',
  coalesce(',"gpc_sec":{{"mn_kda":{{"text":"' || coalesce(mn, mn_text) || '","is_number":' || CASE WHEN mn IS NULL THEN 'false' ELSE 'true' END || '}}}}', ''),
  coalesce(',"morphology":{{"sem":"' || sem || '"}}', ''), '}}') AS pruned FROM crows""")
def _(spark, sf):
    rows = merge.valid_predictions(stored(spark, sf, "char"))
    return rows.select("seq", F.to_json(merge.prune_empty(F.col("parse.characterization"), entities.CHARACTERIZATION)).alias("pruned"))


@query("supplement_supported_node", f"""WITH {query_routing.PROC_TASKS},
refs AS (SELECT doc_id, sample_index, route_role, lower(concat(segment_title, ' ', section_title)) AS t, lower(segment_title) AS st, chunk_index, start, section_title, line_start + start AS l1, line_start + stop - 1 AS l2,
  row_number() OVER (PARTITION BY doc_id, sample_index ORDER BY chunk_index, start) AS k FROM final WHERE route_role = 'process_support'),
named AS (SELECT *, CASE {" ".join(f"WHEN contains(t, '{w}') THEN '{n}'" for w, n in merge.SUPPORTED_NODES)} END AS node, {any_of('st', [w for w, _ in merge.SUPPORTED_NODES])} AS own FROM refs),
picked AS (SELECT doc_id, sample_index, arg_min(node, k) FILTER (node IS NOT NULL) AS node FROM named GROUP BY ALL),
whole AS (SELECT t.doc_id, t.sample_index, coalesce(p.node, CASE {" ".join(f"WHEN contains(lower(text), '{w}') THEN '{n}'" for w, n in merge.SUPPORTED_NODES)} END) AS node FROM tasks t LEFT JOIN picked p USING (doc_id, sample_index)),
place AS (SELECT n.doc_id, n.sample_index, arg_min(concat('line ', l1, '-', l2), k) AS md_range FROM named n JOIN whole w USING (doc_id, sample_index) WHERE own OR contains(st, w.node) GROUP BY ALL)
SELECT w.doc_id, w.sample_index, w.node AS product_name, p.md_range FROM whole w JOIN smp USING (doc_id, sample_index) LEFT JOIN place p ON p.doc_id = w.doc_id AND p.sample_index = w.sample_index
WHERE lower(sample_form) = 'film' AND w.node IS NOT NULL""")
def _(spark, sf):
    from scholion.operators.tasks import build_proc_tasks

    tasks = build_proc_tasks(sections(spark, sf), query_routing.samples(spark, sf, "proc"))
    kind = final.PAYLOAD_TYPE["proc"]
    step = F.struct(*[(F.col("anchor.name") if f.name == "product_name" else F.lit(None).cast(f.dataType)).alias(f.name) for f in kind.elementType.fields])
    rows = merge.supplement_supported_node(tasks.withColumn("payload", F.array(step).cast(kind)))
    return rows.where(F.size("payload") == 2).select("doc_id", "sample_index", F.col("payload")[1]["product_name"].alias("product_name"),
                                                    F.col("payload")[1]["location"]["md_range"].alias("md_range"))


# --- validation

@query("validate_entities", """SELECT event_id, concat_ws('; ',
  CASE WHEN event_id % 7 = 1 THEN 'temp_c must be >= 0' END, CASE WHEN event_id % 5 = 2 THEN 'yield_percent must be within [0, 100]' END) AS errors FROM events""")
def _(spark, sf):
    text = F.expr("concat('{\"application\":{\"regeneration\":{\"temp_c\":', CASE WHEN event_id % 7 = 1 THEN -5 ELSE 500 END, ',\"yield_percent\":', CASE WHEN event_id % 5 = 2 THEN 101.5 ELSE 99 END, '}}}')")
    rows = derived.table(spark, sf, "events").select("event_id", answers.read_record(text, entities.APPLICATION_RESULT)["rec"].alias("parse"))
    return rows.select("event_id", F.array_join(validate.rule_errors(F.col("parse"), "application_v1"), "; ").alias("errors"))


@query("unknown_and_missing_keys", """SELECT event_id, concat_ws('; ', CASE WHEN event_id % 4 = 0 THEN 'properties.name: missing' END, CASE WHEN event_id % 3 = 0 THEN 'properties.odd: unknown key' END,
  CASE WHEN event_id % 2 = 1 THEN 'properties.value.other: unknown key' END) AS errors FROM events""")
def _(spark, sf):
    text = F.expr("concat('{\"性质\":[{\"类别\":\"c\",\"名称\":\"', CASE WHEN event_id % 4 = 0 THEN ' ' ELSE 'n' END, '\",', CASE WHEN event_id % 3 = 0 THEN '\"odd\":1,' ELSE '' END, "
                  "'\"值\":{\"单值\":1', CASE WHEN event_id % 2 = 1 THEN ',\"other\":2' ELSE '' END, '},\"测试条件\":{\"free\":3}}]}')")
    return derived.table(spark, sf, "events").select("event_id", F.array_join(answers.read_record(text, entities.PROP_RESULT)["errs"], "; ").alias("errors"))


@query("validate_samples", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE source || '|' || lang END AS names, lang AS aliases FROM documents""")
def _(spark, sf):
    text = F.expr("concat('{\"文献信息\":{},\"why\":\"w\",\"聚合物\":[{\"名称\":\"', source, '\",\"别名\":[\"', lang, '\",\" ', upper(lang), ' \",\"', upper(source), '\"]},{\"名称\":\" ', "
                  "CASE WHEN doc_id % 2 = 0 THEN upper(source) ELSE lang END, ' \",\"样本形态\":null}],\"n\":', n_chars, '}')")
    rows = derived.table(spark, sf, "documents").select("doc_id", validate.clean_main_signal(
        answers.read_record(text, entities.MAIN_SIGNAL)["rec"]).alias("m"))
    return rows.select("doc_id", F.array_join(F.transform("m.samples", lambda s: s["name"]), "|").alias("names"),
                       F.array_join(F.get("m.samples", F.lit(0))["aliases"], "|").alias("aliases"))


@query("validate_material_ids", """SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN source ELSE source || '|' || lang END AS ids, lang AS aliases FROM documents""")
def _(spark, sf):
    text = F.expr("concat('{\"why\":\"', n_chars, '\",\"material_ids\":[{\"id\":\"', source, '\",\"aliases\":[\"', lang, '\",\"', upper(lang), ' \"],\"why\":\"w\"},{\"id\":\" ', "
                  "CASE WHEN n_chars % 3 = 0 THEN upper(source) ELSE lang END, '\",\"why\":\"w\"}]}')")
    rows = derived.table(spark, sf, "documents").select("doc_id", validate.clean_material_ids(
        answers.read_record(text, entities.MATERIAL_IDS)["rec"]).alias("m"))
    return rows.select("doc_id", F.array_join(F.transform("m.material_ids", lambda s: s["id"]), "|").alias("ids"),
                       F.array_join(F.get("m.material_ids", F.lit(0))["aliases"], "|").alias("aliases"))


@query("unknown_key_modes", """SELECT event_id, '' AS main_errors, event_type AS main_name, 'characterization.morphology.' || event_type || ': unknown key' AS char_errors,
  event_type AS char_sem, '' AS proc_errors, event_type || '=' || user_id AS proc_extra, '' AS v1_errors, event_type AS v1_type FROM events""")
def _(spark, sf):
    read = lambda text, entity: answers.read_record(F.expr(f"concat({text})"), entity)
    told = lambda column: F.array_join(column["errs"], "; ")
    rows = derived.table(spark, sf, "events").select(
        "event_id",
        read("""'{"文献信息":{"odd":', props, '},"why":"w","', event_type, '":1,"聚合物":[{"名称":"', event_type, '","free":2}]}'""", entities.MAIN_SIGNAL).alias("main"),
        read("""'{"表征":{"形貌":{"SEM":"', event_type, '","', event_type, '":', props, '}},"why":"w"}'""", entities.CHAR_RESULT).alias("char"),
        read("""'{"工艺流程":[{"产物名称":"p","原料":[{"原料名称":"m","', event_type, '":"', user_id, '"}]}],"why":"w"}'""", entities.PROC_RESULT).alias("proc"),
        read("""'{"material_id":"m","synthesis":{"zeolite_type":"', event_type, '","free":', props, '},"more":[1]}'""", entities.SYNTHESIS_RESULT).alias("v1"))
    kept = F.get(F.get("proc.rec.steps", F.lit(0))["materials"], F.lit(0))["extra"]
    return rows.select(
        "event_id", told(F.col("main")).alias("main_errors"), F.get("main.rec.samples", F.lit(0))["name"].alias("main_name"),
        told(F.col("char")).alias("char_errors"), F.col("char.rec.characterization.morphology.sem").alias("char_sem"),
        told(F.col("proc")).alias("proc_errors"), F.array_join(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("proc_extra"),
        told(F.col("v1")).alias("v1_errors"), F.col("v1.rec.synthesis.zeolite_type").alias("v1_type"))


@query("repair_deep_answers", """WITH a AS (SELECT event_id, '{"p":' || props || ',"deep":' || repeat('[', 40 + (user_id % 60)::INT) AS t, repeat(']', 40 + (user_id % 60)::INT) AS z, event_type FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN t || '1' || z || '}' WHEN 1 THEN t || '"' || event_type || '"' || z || '}' WHEN 2 THEN t || '1' || z || '}' ELSE t || '2' || z || '}' END AS repaired FROM a""")
def _(spark, sf):
    # cut off within a number, a string, a literal, and whole with another object behind it
    deep = F.expr("concat('{\"p\":', props, ',\"deep\":', repeat('[', 40 + cast(user_id % 60 AS int)), CASE event_id % 4 WHEN 0 THEN '1' "
                  "WHEN 1 THEN concat('\"', event_type) WHEN 2 THEN '1,tru' ELSE concat('2', repeat(']', 40 + cast(user_id % 60 AS int)), '} and {\"b\":2}') END)")
    return derived.table(spark, sf, "events").select("event_id", answers.repair_json(deep).alias("repaired"))



# --- final merge: users stand in for samples of one document each

def after_rows(spark, sf, route: str) -> DataFrame:
    """Answers as after-stage rows: several payloads per (doc_id, sample_id)."""
    field = merge.PAYLOAD_FIELD[route]
    return merge.valid_predictions(stored(spark, sf, route)).select(
        F.concat(F.lit(" d"), F.regexp_extract("task_id", r"u(\d+)", 1)).alias("doc_id"), F.lit("s1").alias("sample_id"),
        F.struct("file_order", "seq").alias("ord"), F.col(f"parse.{field}").alias("payload"))


def user_documents(spark, sf) -> DataFrame:
    """Users, and their events' types, as documents with two samples, of which the first of a user can have payloads."""
    users = derived.table(spark, sf, "events").select(F.explode(F.array(F.col("user_id").cast("string"), "event_type")).alias("u")).distinct()
    sample = lambda k: F.struct(*[F.lit(None).cast("string").alias(n) for n in ("category_name", "category_code")], F.lit(f"sample {k}").alias("name"),
                                *[F.lit(None).cast("string").alias(n) for n in ("sample_form", "structure_l1", "structure_l2")], F.lit(f"s{k}").alias("sample_id"))
    return users.select(F.lit("run").alias("run_id"), F.concat(F.lit("d"), "u").alias("doc_id"), F.array(sample(1), sample(2)).alias("samples"))


def payload_tables(spark, sf) -> dict[str, DataFrame]:
    return {route: final.payloads_by_sample(after_rows(spark, sf, route), route) for route in final.ROUTES}


@query("payloads_by_sample", f"""WITH {CHAR_ROWS.strip()} SELECT concat('d', regexp_extract(task_id, 'u(\\d+)', 1)) AS doc_id, 's1' AS sample_id, peaks, mn, sem FROM peak_lists JOIN scalars USING (task_id)""")
def _(spark, sf):
    return final.payloads_by_sample(after_rows(spark, sf, "char"), "char").select(
        "doc_id", "sample_id", F.array_join("payload.ftir.peaks_cm_1", "|").alias("peaks"), F.col("payload.gpc_sec.mn_kda.text").alias("mn"), F.col("payload.morphology.sem").alias("sem"))


USERS = "u AS (SELECT DISTINCT unnest([user_id::varchar, event_type]) AS u FROM events)"


@query("final_documents", f"""WITH {MERGED_PROPS.strip()}, {CHAR_ROWS.strip()}, {STEP_ROWS.strip()}, {USERS},
props AS (SELECT task_id, count(*) AS n FROM weak WHERE NOT drop GROUP BY task_id),
made AS (SELECT task_id, count(*) AS n, arg_min(product, first_ord) AS first_product FROM steps GROUP BY task_id)
SELECT concat('d', u) AS doc_id, k AS pos, concat('sample ', k + 1) AS name, CASE WHEN k = 0 THEN sem END AS sem, CASE WHEN k = 0 THEN peaks END AS peaks, CASE WHEN k = 0 THEN coalesce(p.n, 0) ELSE 0 END AS n_properties,
  CASE WHEN k = 0 THEN coalesce(m.n, 0) ELSE 0 END AS n_steps, CASE WHEN k = 0 THEN first_product END AS first_product
FROM u, (VALUES (0), (1)) v(k) LEFT JOIN scalars s ON s.task_id = concat('run__u', u, '__characterization') LEFT JOIN peak_lists l ON l.task_id = s.task_id
LEFT JOIN props p ON p.task_id = concat('run__u', u, '__property') LEFT JOIN made m ON m.task_id = concat('run__u', u, '__process')""")
def _(spark, sf):
    docs = final.final_documents(user_documents(spark, sf), payload_tables(spark, sf))
    return docs.select("doc_id", F.posexplode("samples").alias("pos", "s")).select(
        "doc_id", "pos", "s.name", F.col("s.characterization.morphology.sem").alias("sem"), F.array_join("s.characterization.ftir.peaks_cm_1", "|").alias("peaks"),
        F.size("s.properties").alias("n_properties"), F.size("s.process").alias("n_steps"), F.get("s.process", F.lit(0))["product_name"].alias("first_product"))


@query("merge_coverage", f"""WITH {USERS}, g AS (SELECT DISTINCT user_id FROM events WHERE {derived.VALID_EVENT}), c AS (SELECT (SELECT count(*) FROM u) AS docs, (SELECT count(*) FROM g) AS records)
SELECT 'doc_count' AS metric, docs AS value FROM c UNION ALL SELECT 'sample_count', 2 * docs FROM c""" + "".join(
    f" UNION ALL SELECT '{c}_record_count', records FROM c UNION ALL SELECT 'matched_{c}_count', records FROM c" for c in final.COLUMN.values()))
def _(spark, sf):
    return final.merge_coverage(user_documents(spark, sf), payload_tables(spark, sf))


# --- pairing

KEYS = r"""
keyed AS (SELECT 'left' AS side, name, trim(regexp_replace(regexp_replace(lower(regexp_replace(name, '\.[^.]+$', '')), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS k FROM lefts
  UNION ALL SELECT 'right', name, trim(regexp_replace(regexp_replace(lower(regexp_replace(name, '_content_list\.[^.]+$', '')), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) FROM rights),
uniq AS (SELECT side, k, any_value(name) AS name FROM keyed GROUP BY side, k HAVING count(*) = 1),
exact AS (SELECT l.name AS left_name, r.name AS right_name, 1.0::double AS score FROM uniq l JOIN uniq r ON l.k = r.k AND l.side = 'left' AND r.side = 'right')"""


@query("normalize_keys", f"WITH {derived.PAIR_DUCK.strip()}, {KEYS.strip()} SELECT side, name, k AS normalized, array_to_string(list_sort(string_split(k, ' ')), ' ') AS token_sorted FROM keyed")
def _(spark, sf):
    left, right = derived.pair_names(spark, sf)
    return pairing.normalize_keys(left, "left").withColumn("side", F.lit("left")).unionByName(
        pairing.normalize_keys(right, "right").withColumn("side", F.lit("right")))


@query("exact_pairs", f"WITH {derived.PAIR_DUCK.strip()}, {KEYS.strip()} SELECT * FROM exact")
def _(spark, sf):
    left, right = derived.pair_names(spark, sf)
    return pairing.exact_pairs(pairing.normalize_keys(left, "left"), pairing.normalize_keys(right, "right"))


def _report(spark, sf) -> DataFrame:
    return pairing.pairing_report(*derived.pair_names(spark, sf))


@query("pairing_report")
def _(spark, sf):
    return _report(spark, sf)


@query("fuzzy_candidates")
def _(spark, sf):
    left, right = derived.pair_names(spark, sf)
    return pairing.fuzzy_candidates(pairing.normalize_keys(left, "left"), pairing.normalize_keys(right, "right"))


@query("rename_matched")
def _(spark, sf):
    return pairing.rename_matched(_report(spark, sf))

"""Checked queries on sources, sections and document context."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.functions.text import WHITESPACE
from scholion.operators import context, lines, sectioning, stats
from scholion.plans import derived
from scholion.sources import corpus
from scholion.sources.routing_config import route_config

WS = WHITESPACE.replace("'", "''")
NOT_BLANK = r"[^\s]"


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# --- DuckDB building blocks: the same rules as set operations on lines

SECTION_CTES = rf"""
docs AS (SELECT * FROM {derived.DOCS_DUCK}),
lines AS (SELECT doc_id, unnest(range(0, len(string_split(content, chr(10))))) AS i,
    unnest(string_split(content, chr(10))) AS line FROM docs),
heads AS (SELECT doc_id, i, len(regexp_extract(line, '^(#{{1,6}})', 1)) AS level,
    trim(regexp_extract(line, '^#{{1,6}}[ \t]+(.+)$', 1), '{WS}') AS title FROM lines
  WHERE regexp_matches(line, '^#{{1,6}}[ \t]+.+$')),
numbered AS (SELECT *, nullif(regexp_extract(title, '^(\d+(?:\.\d+)*)(?:\.(?:[^\d]|$)|\s+|$)', 1), '') AS number FROM heads),
outlined AS (SELECT *, CASE WHEN number IS NOT NULL THEN len(string_split(number, '.')) END AS outline FROM numbered),
info AS (SELECT d.doc_id, d.file_name, len(string_split(d.content, chr(10))) AS n_lines, len(d.content) AS n_chars,
    regexp_matches(d.content, '{NOT_BLANK}') AS has_text, count(h.i) AS n_heads,
    coalesce(bool_or(h.i IS NOT NULL AND (h.outline IS NULL OR h.outline = 1)), false) AS has_top, min(h.i) AS first_head
  FROM docs d LEFT JOIN outlined h USING (doc_id) GROUP BY ALL),
starts AS (
  SELECT h.doc_id, CASE WHEN row_number() OVER (PARTITION BY h.doc_id ORDER BY i) = 1 THEN 0 ELSE i END AS s, level,
    1 AS rank, title, number FROM outlined h JOIN info USING (doc_id) WHERE has_top AND (outline IS NULL OR outline = 1)
  UNION ALL SELECT h.doc_id, i, level, coalesce(outline, level), title, number FROM outlined h JOIN info USING (doc_id)
    WHERE NOT has_top
  UNION ALL SELECT doc_id, 0, 0, 0, '__PREFACE__', NULL FROM info WHERE n_heads > 0 AND NOT has_top AND EXISTS
    (SELECT 1 FROM lines l WHERE l.doc_id = info.doc_id AND l.i < first_head AND regexp_matches(line, '{NOT_BLANK}'))
  UNION ALL SELECT doc_id, 0, 0, 0, '__FULL_TEXT__', NULL FROM info WHERE n_heads = 0 AND has_text),
cut AS (SELECT st.*, coalesce(lead(s) OVER (PARTITION BY doc_id ORDER BY s), n_lines) AS e, n_lines
  FROM starts st JOIN info USING (doc_id)),
bodied AS (SELECT c.doc_id, c.s, bool_or(regexp_matches(line, '{NOT_BLANK}')
    AND NOT regexp_matches(line, '^\s*#{{1,6}}[ \t]+.*\S')) AS has_body
  FROM cut c JOIN lines l ON l.doc_id = c.doc_id AND l.i >= c.s AND l.i < c.e GROUP BY ALL),
opened AS (SELECT c.*, CASE WHEN coalesce(lag(has_body) OVER (PARTITION BY c.doc_id ORDER BY c.s), true) THEN 1 ELSE 0 END AS opens
  FROM cut c JOIN bodied b ON b.doc_id = c.doc_id AND b.s = c.s),
islands AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS section_index FROM opened),
blocks AS (SELECT doc_id, section_index, min(s) AS s, max(e) AS e, any_value(n_lines) AS n_lines, arg_min(level, s) AS header_level,
    arg_min(rank, s) AS title_level, arg_min(CASE WHEN title = '' THEN '__UNTITLED__' ELSE title END, s) AS section_title,
    arg_min(struct_pack(n := number), s).n AS section_number FROM islands GROUP BY ALL),
offsets AS (SELECT doc_id, i, sum(len(line) + 1) OVER (PARTITION BY doc_id ORDER BY i) - len(line) - 1 AS at, line FROM lines),
sections AS (SELECT b.doc_id, any_value(info.file_name) AS file_name, section_index - 1 AS chunk_index,
    'b' || lpad(section_index::varchar, 4, '0') AS block_id, section_index,
    any_value(header_level) AS header_level, any_value(title_level) AS title_level, any_value(section_number) AS section_number,
    any_value(section_title) AS section_title,
    b.s + 1 + max(CASE WHEN o.i = b.s AND o.line = '' AND b.s < b.n_lines - 1 THEN 1 ELSE 0 END) AS line_start,
    CASE WHEN b.e < b.n_lines THEN b.e + 1 ELSE b.n_lines END AS line_end,
    min(o.at) AS char_start, CASE WHEN b.e < b.n_lines THEN max(o.at + len(o.line) + 1) ELSE any_value(info.n_chars) END AS char_end,
    trim(string_agg(o.line, chr(10) ORDER BY o.i), '{WS}') AS content
  FROM blocks b JOIN offsets o ON o.doc_id = b.doc_id AND o.i >= b.s AND o.i < b.e JOIN info ON info.doc_id = b.doc_id
  GROUP BY b.doc_id, section_index, b.s, b.e, b.n_lines),
section_lines AS (SELECT doc_id, chunk_index, section_title, line_start,
    unnest(range(0, len(string_split(content, chr(10))))) AS i, unnest(string_split(content, chr(10))) AS line FROM sections),
titled AS (SELECT *, upper(trim(regexp_replace(section_title, '\s+', ' ', 'g'))) AS k FROM sections)"""


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sectioning.split_sections(derived.docs(spark, sf_dir), derived.RUN_ID)


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under its name, with the SQL that must give the same rows."""
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def with_sections(select: str) -> str:
    return f"WITH {SECTION_CTES}\n{select}"


def more(ctes: str, select: str) -> str:
    return f"WITH {SECTION_CTES},\n{ctes}\n{select}"


@query("raw_corpus", f"SELECT file_name, md5(content) AS md5, len(content) AS n_chars FROM {derived.DOCS_DUCK}")
def _(spark, sf):
    return corpus.raw_rows(derived.docs(spark, sf)).select("file_name", "md5", F.length("content").alias("n_chars"))


@query("flatten_corpus", """
SELECT path, stem, concat(stem, '.md') AS file_name FROM (
  SELECT concat('/corpus/', source, '/', cast(doc_id AS varchar), '/', concat('t', substr(md5(text), 1, 3)), '.md') AS path,
    concat('t', substr(md5(text), 1, 3)) AS stem FROM documents)
QUALIFY row_number() OVER (PARTITION BY stem ORDER BY path) = 1""")
def _(spark, sf):
    files = derived.table(spark, sf, "documents").select(
        F.concat_ws("/", F.lit("/corpus"), "source", F.col("doc_id").cast("string"),
                    F.concat(F.lit("t"), F.substring(F.md5(F.col("text").cast("binary")), 1, 3), F.lit(".md"))).alias("path"),
        F.col("text").alias("content"))
    return corpus.flatten_corpus(files).select("path", "stem", "file_name")


@query("normalize_raw", f"""
SELECT row_number() OVER (ORDER BY paper_no) AS doc_index, coalesce(lower(trim(md5)), md5(content)) AS doc_id,
  file_name, len(content) AS n_chars, md5 IS NULL AS md5_fallback FROM {derived.RAW_DUCK}""")
def _(spark, sf):
    return sectioning.normalize_raw(derived.raw(spark, sf), "paper_no").select(
        "doc_index", "doc_id", "file_name", F.length("content").alias("n_chars"), "md5_fallback")


@query("detect_headings", with_sections("""
SELECT doc_id, i AS line_index, level AS header_level, title, number AS section_number, outline AS outline_level FROM outlined"""))
def _(spark, sf):
    return sectioning.detect_headings(derived.docs(spark, sf))


@query("split_sections", with_sections("""
SELECT doc_id, chunk_index, block_id, section_index, header_level, title_level, section_number, section_title, content FROM sections"""))
def _(spark, sf):
    return sections(spark, sf).select("doc_id", "chunk_index", "block_id", "section_index", "header_level", "title_level",
                                      "section_number", "section_title", "content")


@query("collapse_heading_only", with_sections("""
SELECT c.doc_id, count(*) AS n_before, any_value(b.n) AS n_after FROM cut c
JOIN (SELECT doc_id, count(*) AS n FROM blocks GROUP BY doc_id) b USING (doc_id) GROUP BY c.doc_id"""))
def _(spark, sf):
    docs = derived.docs(spark, sf)

    def counted(collapse: bool, name: str) -> DataFrame:
        return sectioning.split_sections(docs, "run", collapse=collapse).groupBy("doc_id").agg(
            F.count(F.lit(1)).alias(name))

    return counted(False, "n_before").join(counted(True, "n_after"), "doc_id")


@query("section_spans", with_sections("""
SELECT doc_id, chunk_index, line_start, line_end, char_start, char_end FROM sections"""))
def _(spark, sf):
    return sections(spark, sf).select(
        "doc_id", "chunk_index", F.col("line_span")[0].alias("line_start"), F.col("line_span")[1].alias("line_end"),
        F.col("char_span")[0].alias("char_start"), F.col("char_span")[1].alias("char_end"))


@query("section_metrics", with_sections(rf"""
SELECT doc_id, chunk_index, len(any_value(content)) AS content_char_len,
  count(*) FILTER (regexp_matches(line, '{NOT_BLANK}')) AS content_non_empty_lines,
  count(*) FILTER (regexp_matches(line, '{NOT_BLANK}') AND NOT regexp_matches(line, '^\s*#{{1,6}}[ \t]+.*\S')) AS effective_body_non_empty_lines
FROM section_lines JOIN sections USING (doc_id, chunk_index) GROUP BY doc_id, chunk_index"""))
def _(spark, sf):
    return sectioning.section_metrics(sections(spark, sf)).drop("run_id")


@query("human_chunks", with_sections(rf"""
SELECT s.doc_id, s.chunk_index, concat('source_file: ', any_value(s.file_name), chr(10), 'doc_id: ', s.doc_id, chr(10), 'chunk_index: ', s.chunk_index,
  chr(10), 'block_id: ', any_value(s.block_id), chr(10), 'section_number: ', coalesce(any_value(s.section_number), 'None'), chr(10), 'header_level: ', any_value(s.header_level),
  chr(10), 'outline_level: ', any_value(s.title_level), chr(10), 'title_level: ', any_value(s.title_level), chr(10), 'section_title: ', any_value(s.section_title), chr(10),
  'line_span: [', any_value(s.line_start), ', ', any_value(s.line_end), ']', chr(10), 'char_span: [', any_value(s.char_start), ', ', any_value(s.char_end), ']', chr(10),
  'line_count: ', count(*), chr(10), 'effective_body_non_empty_lines: ',
  count(*) FILTER (regexp_matches(line, '{NOT_BLANK}') AND NOT regexp_matches(line, '^\s*#{{1,6}}[ \t]+.*\S')), chr(10), chr(10), 'lines:', chr(10),
  '--- chunk (', any_value(s.block_id), ': ', any_value(s.section_title), ') ---', chr(10),
  string_agg(concat(l.line_start + l.i, ': ', l.line), chr(10) ORDER BY l.i), chr(10)) AS chunk_text
FROM sections s JOIN section_lines l USING (doc_id, chunk_index) GROUP BY s.doc_id, s.chunk_index"""))
def _(spark, sf):
    return sectioning.render_human_chunks(sections(spark, sf)).select("doc_id", "chunk_index", "chunk_text")


@query("doc_split_stats", f"""
WITH {SECTION_CTES}
SELECT 'doc_count' AS metric, count(*) AS value FROM docs UNION ALL SELECT 'block_count', count(*) FROM sections
UNION ALL SELECT 'fallback_md5_count', count(*) FILTER (md5 IS NULL) FROM {derived.RAW_DUCK}""")
def _(spark, sf):
    docs = sectioning.normalize_raw(derived.raw(spark, sf), "paper_no")
    return stats.doc_split_stats(docs, sectioning.split_sections(docs, "run"))


@query("heading_segments", more(r"""
s AS (SELECT *, sum(CASE WHEN i = 0 OR regexp_matches(line, '^\s*#') THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id, chunk_index ORDER BY i) - 1 AS segment FROM section_lines)""",
  'SELECT doc_id, chunk_index, segment, min(i) AS start, max(i) AS "end" FROM s GROUP BY ALL'))
def _(spark, sf):
    return lines.heading_segments(sections(spark, sf)).drop("run_id")


PSEUDO = r"^\s*[A-Z0-9][A-Za-z0-9\-\s/(),%μ\.]{2,80}\.\s*$"
INLINE = r"^\s*([A-Z][A-Za-z0-9\-\s/(),%μ]{2,80})\.\s+\S.+$"
CAPTION = r"(?i)^\s*(figure|fig\.?|table|scheme)([^\pL\pN_]|$)"
SEGMENT_CTE = rf"""
entries AS (SELECT *, CASE
    WHEN regexp_matches(line, '^\s*#{{1,6}}\s*\S') THEN trim(regexp_replace(regexp_extract(line, '^\s*#{{1,6}}\s*(.+)$', 1), '\s+', ' ', 'g'))
    WHEN regexp_matches(line, '{NOT_BLANK}') AND NOT regexp_matches(trim(line, '{WS}'), '^!\[') AND NOT regexp_matches(line, '{CAPTION}')
      AND regexp_matches(trim(line, '{WS}'), '{PSEUDO}') THEN trim(regexp_replace(rtrim(line, '.'), '\s+', ' ', 'g'))
    WHEN regexp_matches(line, '{INLINE}') THEN trim(regexp_replace(regexp_extract(line, '{INLINE}', 1), '\s+', ' ', 'g')) END AS entry
  FROM section_lines),
counted AS (SELECT *, count(entry) OVER (PARTITION BY doc_id, chunk_index ORDER BY i) AS seg,
    count(entry) OVER (PARTITION BY doc_id, chunk_index) AS n_entries FROM entries),
segments AS (SELECT doc_id, chunk_index, any_value(section_title) AS section_title, any_value(line_start) AS line_start,
    CASE WHEN n_entries = 0 THEN 0 ELSE seg - 1 END AS segment,
    coalesce(max(entry), any_value(section_title)) AS segment_title, min(i) AS start, max(i) + 1 AS stop,
    trim(string_agg(line, chr(10) ORDER BY i), '{WS}') AS text
  FROM counted WHERE n_entries = 0 OR seg > 0 GROUP BY doc_id, chunk_index, seg, n_entries)"""


@query("pseudo_heading_segments", more(SEGMENT_CTE, "SELECT doc_id, chunk_index, segment, segment_title, start, stop, text FROM segments"))
def _(spark, sf):
    return lines.pseudo_heading_segments(sections(spark, sf)).drop("run_id")


def _contains_any(values, column: str = "k") -> str:
    return "(" + " OR ".join(f"contains({column}, '{v}')" for v in values) + ")"


BODY = context.INTRO + context.EXPERIMENT + context.RESULTS + context.CONCLUSION
ROLE_FLAGS = f"""
flags AS (SELECT *, section_number IS NOT NULL OR {_contains_any(BODY)} AS is_body,
  {_contains_any(context.EXPERIMENT)} OR k = 'MATERIALS' AS is_experiment, {_contains_any(context.RESULTS)} AS is_results FROM titled),
firsts AS (SELECT doc_id, min(chunk_index) AS first_at, min(chunk_index) FILTER (is_experiment) AS experiment_at,
  min(chunk_index) FILTER (is_results) AS results_at, min(chunk_index) FILTER (is_body AND chunk_index > 0) AS body_at
  FROM flags GROUP BY doc_id),
parts AS (SELECT f.*, f.chunk_index = first_at AS is_title, f.chunk_index < coalesce(body_at, 1) AS is_front,
  f.chunk_index = experiment_at AS at_experiment, f.chunk_index = results_at AS at_results FROM flags f JOIN firsts USING (doc_id))"""


@query("main_section_roles", more(ROLE_FLAGS, "SELECT doc_id, chunk_index, is_body, is_experiment, is_results FROM flags"))
def _(spark, sf):
    return context.classify_sections(sections(spark, sf), "main").select(
        "doc_id", "chunk_index", "is_body", "is_experiment", "is_results")


def oracle_pattern(pattern: str) -> str:
    """A dictionary pattern for RE2, with word boundaries that know all letters."""
    word = r"\pL\pN_"
    out = pattern.replace(r"\.?\b", rf"(?:\.[{word}]|[^{word}]|$)").replace(r"\b.+\b", rf"[^{word}](?:.*[^{word}])?")
    if out.startswith(r"\b"):
        out = rf"(?:^|[^{word}])" + out[2:]
    if out.endswith(r"\b"):
        out = out[:-2] + rf"(?:[^{word}]|$)"
    return out


def any_regex(patterns, column: str) -> str:
    joined = "|".join(f"(?:{oracle_pattern(p)})" for p in patterns).replace("'", "''")
    return f"regexp_matches({column}, '(?i){joined}')"


def role_sql(route: str) -> str:
    config = route_config(route)
    t = {k: _contains_any(v) for k, v in config.titles.items()}
    if route == "proc":
        return (f"CASE WHEN {t['ignore']} THEN 'ignore' WHEN {t['method']} AND {t['support']} THEN 'method_support' WHEN {t['method']} THEN 'method' "
                f"WHEN {t['support']} THEN 'support' WHEN chunk_index = 0 THEN 'front' ELSE 'other' END")
    named = any_regex([p for ps in config.keywords.values() for p in ps], "k")
    front = f"WHEN chunk_index = 0 AND NOT {t['result']} THEN 'front'" if route == "prop" else ""
    return (f"CASE WHEN {t['ignore']} THEN 'ignore' WHEN {t['method']} THEN 'method' {front} "
            f"WHEN {t['result']} OR {named} THEN 'result' ELSE 'other' END")


@query("route_section_roles", with_sections(" UNION ALL ".join(
    f"SELECT doc_id, chunk_index, '{r}' AS route, {role_sql(r)} AS role FROM titled" for r in ("char", "prop", "proc"))))
def _(spark, sf):
    roles = [F.struct(F.lit(r).alias("route"), context.route_role(F.col("section_title"), F.col("chunk_index"), r).alias("role"))
             for r in ("char", "prop", "proc")]
    return sections(spark, sf).select("doc_id", "chunk_index", F.explode(F.array(*roles)).alias("r")).select(
        "doc_id", "chunk_index", "r.*")


@query("front_matter", more(ROLE_FLAGS, "SELECT doc_id, chunk_index, block_id, content FROM parts WHERE is_front"))
def _(spark, sf):
    return context.front_matter(sections(spark, sf)).select("doc_id", "chunk_index", "block_id", "content")


@query("first_sections", more(ROLE_FLAGS, """SELECT doc_id, chunk_index, 'experimental' AS role FROM parts WHERE at_experiment
UNION ALL SELECT doc_id, chunk_index, 'results' FROM parts WHERE at_results"""))
def _(spark, sf):
    s = sections(spark, sf)
    found = [context.first_section(s, r).select("doc_id", "chunk_index", F.lit(r).alias("role")) for r in ("experimental", "results")]
    return found[0].unionByName(found[1])


TAGGED = """
texts AS (SELECT doc_id, string_agg(content, chr(10) || chr(10) ORDER BY chunk_index) FILTER (is_front) AS front,
  max(content) FILTER (at_experiment) AS experiment, max(content) FILTER (at_results) AS results, any_value(file_name) AS file_name FROM parts GROUP BY doc_id),
tagged AS (SELECT doc_id, file_name, concat_ws(chr(10) || chr(10), '[FRONT_MATTER]' || chr(10) || front,
  '[EXPERIMENT]' || chr(10) || experiment, '[RESULTS]' || chr(10) || results) AS text FROM texts)"""


@query("tagged_text", more(ROLE_FLAGS + "," + TAGGED, "SELECT doc_id, text FROM tagged"))
def _(spark, sf):
    return context.document_parts(sections(spark, sf)).select("doc_id", context.render_tagged_text(F.col("parts")).alias("text"))


@query("source_refs", more(ROLE_FLAGS, """
SELECT doc_id, chunk_index, block_id, section_title, line_start, line_end, concat_ws(',', CASE WHEN is_title THEN 'title' END,
  CASE WHEN is_front THEN 'front_matter' END, CASE WHEN at_experiment THEN 'experimental' END, CASE WHEN at_results THEN 'results' END) AS roles
FROM parts WHERE is_title OR is_front OR at_experiment OR at_results"""))
def _(spark, sf):
    return context.document_parts(sections(spark, sf)).select(
        "doc_id", F.explode(context.source_refs(F.col("parts"))).alias("r")).select(
        "doc_id", "r.chunk_index", "r.block_id", "r.section_title", F.col("r.line_span")[0].alias("line_start"),
        F.col("r.line_span")[1].alias("line_end"), F.array_join("r.roles", ",").alias("roles"))


@query("main_signal_tasks", more(ROLE_FLAGS + "," + TAGGED, """
SELECT 'run' AS run_id, doc_id, concat('run__', doc_id, '__main_signal') AS task_id, file_name, text,
  (SELECT count(*) FROM parts p WHERE p.doc_id = tagged.doc_id AND (is_title OR is_front OR at_experiment OR at_results)) AS n_refs FROM tagged"""))
def main_signal_tasks(spark, sf):
    return context.build_main_signal_tasks(sections(spark, sf)).select(
        "run_id", "doc_id", "task_id", "file_name", "text", F.size("source_refs").alias("n_refs"))


@query("main_signal_task_stats", more(ROLE_FLAGS, """
SELECT 'doc_count' AS metric, count(*) AS value FROM firsts UNION ALL SELECT 'task_count', count(*) FROM firsts
UNION ALL SELECT 'empty_experiment_count', count(*) FILTER (experiment_at IS NULL) FROM firsts"""))
def _(spark, sf):
    return stats.main_signal_before_stats(context.build_main_signal_tasks(sections(spark, sf)))


# --- first generation

V1_CTES = rf"""
docs AS (SELECT * FROM {derived.DOCS_DUCK}),
raw_lines AS (SELECT doc_id, unnest(range(0, len(string_split(content, chr(10))))) AS i,
  trim(unnest(string_split(content, chr(10))), '{WS}') AS line FROM docs),
marked AS (SELECT *, CASE WHEN regexp_matches(line, '^#{{1,4}}( |$)') THEN len(regexp_extract(line, '^(#+)', 1)) END AS level,
  CASE WHEN regexp_matches(line, '^#{{1,4}}( |$)') THEN trim(regexp_replace(line, '^#+', ''), '{WS}') END AS title FROM raw_lines),
runs AS (SELECT *, count(level) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
named AS (SELECT *, max(title) OVER (PARTITION BY doc_id, run) AS h FROM runs WHERE run > 0),
grouped AS (SELECT *, sum(CASE WHEN h IS DISTINCT FROM prev THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM
  (SELECT *, lag(h) OVER (PARTITION BY doc_id ORDER BY i) AS prev FROM named)),
paras AS (SELECT doc_id, g, h, i, line, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, g ORDER BY i) AS para FROM grouped),
joined AS (SELECT doc_id, g, any_value(h) AS content_title, string_agg(t, '  ' || chr(10) ORDER BY para) AS text FROM
  (SELECT doc_id, g, any_value(h) AS h, para, string_agg(line, chr(10) ORDER BY i) AS t FROM paras WHERE line <> '' GROUP BY doc_id, g, para) GROUP BY doc_id, g),
chunks AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g) - 1 AS chunk_index, 'H1' AS title_level, content_title,
  trim(CASE WHEN starts_with(text, '# ' || content_title) THEN substr(text, 3 + len(content_title)) ELSE text END, '{WS}') AS content FROM joined),
v1 AS (SELECT *, upper(content_title) AS u, concat('# ', content_title, chr(10), content) AS block,
  min(chunk_index) FILTER (contains(upper(content_title), 'INTRODUCT')) OVER (PARTITION BY doc_id) AS intro_at,
  max(chunk_index) OVER (PARTITION BY doc_id) AS last_at FROM chunks)"""


def v1_chunks(spark, sf):
    return sectioning.split_by_header_path(derived.docs(spark, sf))


@query("header_path_chunks", f"WITH {V1_CTES} SELECT doc_id, chunk_index, title_level, content_title, content FROM chunks")
def _(spark, sf):
    return v1_chunks(spark, sf).drop("file_name")


@query("paper_context_v1", f"""WITH {V1_CTES},
e AS (SELECT doc_id, min(chunk_index) AS e_at FROM v1 WHERE contains(u, 'EXPERIM') AND chunk_index >= intro_at GROUP BY doc_id),
x AS (SELECT v1.*, e_at, min(CASE WHEN v1.chunk_index > e_at AND substr(v1.content_title, 1, 1) <> substr(t.content_title, 1, 1) THEN v1.chunk_index END)
  OVER (PARTITION BY v1.doc_id) AS stop_at FROM v1 LEFT JOIN e USING (doc_id) LEFT JOIN (SELECT doc_id, chunk_index, content_title FROM v1) t ON t.doc_id = v1.doc_id AND t.chunk_index = e_at)
SELECT doc_id, concat('# ', arg_min(content_title, chunk_index)) AS title,
  coalesce(string_agg(block, chr(10) || chr(10) ORDER BY chunk_index) FILTER (chunk_index < coalesce(intro_at, last_at + 1)), '') AS abstract,
  coalesce(string_agg(block, chr(10) || chr(10) ORDER BY chunk_index) FILTER (chunk_index >= e_at AND chunk_index < coalesce(stop_at, last_at + 1)), '') AS experiment
FROM x GROUP BY doc_id""")
def _(spark, sf):
    return context.paper_context_v1(v1_chunks(spark, sf))


@query("section_bundles_v1", f"""WITH {V1_CTES},
r AS (SELECT *, contains(u, 'RESULTS') OR contains(u, 'DISCUSSION') OR contains(u, 'CONCLUSION') AS trigger,
  contains(u, 'CONCLUSION') OR contains(u, 'ACKNOWLEDGEMENT') OR contains(u, 'REFERENCE') AS stops FROM v1),
s AS (SELECT a.doc_id, a.chunk_index AS t, min(b.chunk_index) AS stop_at FROM r a LEFT JOIN r b ON b.doc_id = a.doc_id AND b.chunk_index > a.chunk_index AND b.stops
  WHERE a.trigger GROUP BY ALL),
f AS (SELECT s.doc_id, string_agg(r.block, chr(10) || chr(10) ORDER BY s.t, r.chunk_index) AS text FROM s JOIN r ON r.doc_id = s.doc_id
  AND r.chunk_index >= s.t AND (r.chunk_index = s.t OR r.chunk_index < coalesce(s.stop_at, 1000000)) GROUP BY s.doc_id)
SELECT r.doc_id, coalesce(string_agg(block, chr(10) || chr(10) ORDER BY chunk_index) FILTER (NOT contains(u, 'REFERENCE')), '') AS effective_section,
  coalesce(string_agg(block, chr(10) || chr(10) ORDER BY chunk_index) FILTER (NOT contains(u, 'REFERENCE') AND chunk_index > 0 AND NOT contains(u, 'INTRODUCTION') AND NOT contains(u, 'ABSTRACT')), '') AS specific_section,
  coalesce(any_value(f.text), '') AS result_and_discussion FROM r LEFT JOIN f USING (doc_id) GROUP BY r.doc_id""")
def _(spark, sf):
    return context.section_bundles_v1(v1_chunks(spark, sf))


DOI_TEXT = ("concat(text, CASE doc_id % 5 WHEN 0 THEN concat(' DOI: https://doi.org/10.1016/j.x.', cast(doc_id AS {s}), ').') "
            "WHEN 1 THEN concat(' see https://dx.doi.org/10.1038/s', cast(doc_id AS {s}), '.') WHEN 2 THEN concat(' (10.1002/a-', cast(doc_id AS {s}), ')') "
            "WHEN 3 THEN concat(' doi:10.1021/ab', cast(doc_id AS {s}), ' and 10.1/x') ELSE '' END)")
DOI_SQL = "coalesce(" + ", ".join(
    f"nullif(regexp_extract(t, '(?i){p.replace(chr(92) + 'b', '(?:^|[^A-Za-z0-9_])', 1) if p.startswith(chr(92) + 'b') else p}', 1), '')"
    for p in context.DOI_PATTERNS) + ")"


@query("extract_doi", f"""SELECT doc_id, regexp_replace({DOI_SQL}, '[.,;:)\\]}}\\s]+$', '') AS doi
FROM (SELECT doc_id, {DOI_TEXT.format(s='varchar')} AS t FROM documents)""")
def _(spark, sf):
    return derived.table(spark, sf, "documents").select(
        "doc_id", context.extract_doi(F.expr(DOI_TEXT.format(s="string"))).alias("doi"))


@query("equal_files", """SELECT concat('f', doc_id, '.md') AS file_name, concat('[FRONT_MATTER]', chr(10), '# Abstract', chr(10), trim(text, chr(10) || ' ')) AS text FROM documents""")
def _(spark, sf):
    # documents has exact copies, so files of equal content and equal doc_id
    files = derived.table(spark, sf, "documents").select(
        F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file_name"), F.concat(F.lit("# Abstract\n"), F.col("text")).alias("content"))
    numbered = sectioning.normalize_raw(corpus.raw_rows(files))
    return context.build_main_signal_tasks(sectioning.split_sections(numbered, derived.RUN_ID)).select("file_name", "text")

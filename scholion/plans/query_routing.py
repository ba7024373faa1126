"""Checked queries on routing: terms, labels, windows, segments and tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scholion.functions import vocab
from scholion.functions.arrays import as_made
from scholion.operators import anchors, lines, segments, stats, tasks, windows
from scholion.plans import derived
from scholion.plans.query_sections import (
    CAPTION, SECTION_CTES, SEGMENT_CTE, WS, any_regex, oracle_pattern, role_sql, sections, sql_list,
)
from scholion.sources.routing_config import load_routing_config, route_config

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return add


def samples(spark: SparkSession, sf: str, route: str) -> DataFrame:
    rows = derived.samples(spark, sf).withColumn("run_id", F.lit(derived.RUN_ID))
    return anchors.anchor_rows(rows, route)


def shown(items: str | Column) -> Column:
    """A list as one text, so that engines compare by value."""
    return F.array_join(F.array_sort(items), "|")


def as_list(items: str | Column) -> Column:
    return F.array_join(items, "|")


# --- terms in DuckDB: one row per candidate term, first spelling kept

RATIO_RE = r"(?i)(?:^|[^\pL\pN_])(\d+(?:\.\d+)?\s*wt\s*%)[\pL\pN_]"
TOKEN_RE = r"(?:^|[^\pL\pN_])([A-Z][A-Z0-9/+-]*[A-Z0-9])"


def term_sql(route: str) -> str:
    """CTEs ``aterms`` and ``fterms`` (doc_id, sample_index, ord, label) of a route."""
    short = "" if route == "char" else " AND NOT (len(category_code) <= 6 AND regexp_full_match(category_code, '[A-Z0-9+-]+') AND name IS NOT NULL)"
    variants = "" if route == "proc" else """
  UNION ALL SELECT doc_id, sample_index, 4, replace(category_code, '/', '-') FROM smp WHERE contains(category_code, '/')
  UNION ALL SELECT doc_id, sample_index, 5, replace(category_code, '/', ' / ') FROM smp WHERE contains(category_code, '/')"""
    anchor_variants = variants or """
  UNION ALL SELECT doc_id, sample_index, 4, replace(category_code, '/', '-') FROM smp WHERE contains(category_code, '/')
  UNION ALL SELECT doc_id, sample_index, 5, replace(category_code, '/', ' / ') FROM smp WHERE contains(category_code, '/')"""
    return rf"""
smp AS (SELECT * FROM {derived.SAMPLES_DUCK}),
araw AS (SELECT doc_id, sample_index, 1 AS o, name AS label FROM smp
  UNION ALL SELECT doc_id, sample_index, 3, category_code FROM smp WHERE category_code IS NOT NULL{short}{anchor_variants}
  UNION ALL SELECT doc_id, sample_index, 6, category_name FROM smp WHERE lower(category_name) NOT IN ({sql_list(vocab.GENERIC_CATEGORY_NAMES)})),
aterms AS (SELECT doc_id, sample_index, row_number() OVER (PARTITION BY doc_id, sample_index ORDER BY o) - 1 AS ord, label FROM
  (SELECT * FROM araw WHERE label IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id, sample_index, lower(label) ORDER BY o) = 1)),
fbase AS (SELECT doc_id, sample_index, 3 AS o, category_code AS label FROM smp WHERE category_code IS NOT NULL{variants}
  UNION ALL SELECT doc_id, sample_index, 6, category_name FROM smp WHERE category_name IS NOT NULL
  UNION ALL SELECT doc_id, sample_index, 7, trim(regexp_replace(regexp_replace(name, '(?i)\d+(\.\d+)?\s*wt\s*%([\pL\pN_])', '\2', 'g'), '\s+', ' ', 'g')) FROM smp),
fraw AS (SELECT doc_id, sample_index, o, 0 AS k, label FROM fbase
  UNION ALL SELECT doc_id, sample_index, o, unnest(range(1, len(t) + 1)) AS k, unnest(t) AS label FROM
    (SELECT *, list_filter(regexp_extract_all(label, '{TOKEN_RE}', 1), lambda x: len(x) >= 2) AS t FROM fbase)),
fterms AS (SELECT doc_id, sample_index, row_number() OVER (PARTITION BY doc_id, sample_index ORDER BY o, k) - 1 AS ord, label FROM
  (SELECT * FROM fraw QUALIFY row_number() OVER (PARTITION BY doc_id, sample_index, lower(label) ORDER BY o, k) = 1))"""


def hit_sql(text: str, label: str, route: str) -> str:
    """Boolean: the term occurs in the text."""
    plural = "" if route == "char" else "s?"
    escaped = f"regexp_replace({label}, '([^\\pL\\pN ])', '\\\\\\1', 'g')"
    return (f"CASE WHEN NOT contains(lower({text}), lower({label})) THEN false "
            f"WHEN len({label}) <= 6 AND regexp_full_match({label}, '[A-Z0-9/+-]+') THEN "
            f"regexp_matches({text}, concat('(^|[^A-Za-z0-9/+-])', {escaped}, '{plural}([^A-Za-z0-9/+-]|$)')) "
            f"ELSE true END")


def strong_sql(text: str, label: str, route: str) -> str:
    """Boolean: the term occurs and no variant tail follows; tailed hits are cut out first."""
    escaped = f"regexp_replace({label}, '([^\\pL\\pN ])', '\\\\\\1', 'g')"
    tail = vocab.VARIANT_TAIL[route].removesuffix(r"\b")
    cut_text = (f"regexp_replace({text}, concat('(?i)', {escaped}, '{tail}([^\\pL\\pN_]|$)'), ' ', 'g')")
    cut_code = (f"regexp_replace({text}, concat('(^|[^A-Za-z0-9/+-])', {escaped}, '(?:s)?(?i:{tail})([^\\pL\\pN_]|$)'), '\\1 ', 'g')")
    return (f"CASE WHEN NOT contains(lower({text}), lower({label})) THEN false "
            f"WHEN len({label}) <= 6 AND regexp_full_match({label}, '[A-Z0-9/+-]+') THEN "
            f"regexp_matches({cut_code}, concat('(^|[^A-Za-z0-9/+-])', {escaped}, 's?([^A-Za-z0-9/+-]|$)')) "
            f"ELSE contains(lower({cut_text}), lower({label})) END")


def forms_sql(text: str, route: str) -> str:
    """List of forms a text names: its words looked up with their plural endings."""
    pairs = [(w + e, form) for form, ws in vocab.FORM_WORDS[route].items() for w in ws for e in vocab.PLURAL_ENDINGS[route]]
    keys, values = sql_list(k for k, _ in pairs), sql_list(v for _, v in pairs)
    return (f"list_distinct(list_filter(list_transform(string_split_regex(lower({text}), '[^a-z]+'), "
            f"lambda w: ([{values}])[list_position([{keys}], w)]), lambda f: f IS NOT NULL))")


def groups_sql(forms: str) -> str:
    keys, values = sql_list(vocab.FORM_GROUPS), sql_list(vocab.FORM_GROUPS.values())
    return f"list_distinct(list_concat({forms}, list_transform({forms}, lambda f: ([{values}])[list_position([{keys}], f)])))"


def ratios_sql(text: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({text}, '{RATIO_RE}', 1), lambda r: regexp_replace(lower(r), '\\s+', '', 'g')))"


def labels_sql(text: str, route: str) -> str:
    """Sorted list of dictionary labels of a text."""
    tests = ", ".join(f"CASE WHEN {any_regex(ps, text)} THEN '{k}' END" for k, ps in route_config(route).keywords.items())
    return f"list_sort(list_filter([{tests}], lambda x: x IS NOT NULL))"


def route_base(route: str) -> str:
    """Sections with roles, labelled lines with features, samples with anchors."""
    fluid = sql_list(vocab.FLUID_FORMS)
    widen = (lambda x: x) if route == "char" else groups_sql
    config = route_config(route)
    variant = ("regexp_matches(concat_ws(' ', name, category_code, category_name), "
               f"'(?i){'|'.join(oracle_pattern(p) for p in vocab.VARIANT_MARKERS[route])}')" if route != "char" else "false")
    return rf"""{SECTION_CTES},
roled AS (SELECT *, {role_sql(route)} AS role, {labels_sql('section_title', route)} AS title_labels FROM titled),
labelled AS (SELECT * FROM (SELECT l.*, {labels_sql('line', route)} AS labels FROM section_lines l) WHERE len(labels) > 0),
{term_sql(route)},
forms0 AS (SELECT *, {forms_sql("coalesce(sample_form, '')", route)} AS f0, {ratios_sql('name')} AS ratios, {variant} AS is_variant FROM smp),
anch AS (SELECT *, {widen('f0')} AS aforms, {groups_sql('f0')} AS agroups, list_has_any(f0, [{fluid}]) AS is_fluid FROM forms0)"""


# --- terms, labels, forms

for _route in ("char", "prop", "proc"):
    for _kind in ("anchor", "family"):
        def _terms(spark, sf, route=_route, kind=_kind):
            make = anchors.anchor_terms if kind == "anchor" else anchors.family_terms
            return make(samples(spark, sf, route), route).select("doc_id", "sample_index", "ord", "label")

        query(f"{_kind}_terms_{_route}", f"WITH {term_sql(_route).strip()} SELECT doc_id, sample_index, ord, label FROM {_kind[0]}terms")(_terms)


@query("explode_samples", f"""SELECT doc_id, sample_index, concat('run__', doc_id, '__', lpad(sample_index::varchar, 3, '0'), '__characterization') AS task_id,
  sample_id, name, category_code, category_name, sample_form FROM {derived.SAMPLES_DUCK}""")
def _(spark, sf):
    nested = derived.samples(spark, sf).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(
        "sample_index", "sample_id", "name", "category_code", "category_name", "sample_form"))).alias("samples"))
    rows = anchors.explode_samples(nested.withColumn("run_id", F.lit(derived.RUN_ID)), "char")
    return anchors.require_sections(rows, sections(spark, sf)).select(
        "doc_id", "sample_index", "task_id", "anchor.sample_id", "anchor.name", "anchor.category_code",
        "anchor.category_name", "anchor.sample_form")


def label_counts_sql(route: str) -> str:
    return f"SELECT '{route}' AS route, unnest(labels) AS label FROM (SELECT {labels_sql('line', route)} AS labels FROM section_lines)"


@query("routing_dictionary_hits", f"""WITH {SECTION_CTES}, hits AS ({label_counts_sql('char')} UNION ALL {label_counts_sql('prop')}),
d(route, label, n_patterns) AS (VALUES {', '.join(f"('{r}', '{k}', {len(ps)})" for r in ('char', 'prop') for k, ps in route_config(r).keywords.items())})
SELECT d.route, d.label, any_value(n_patterns) AS n_patterns, count(h.label) AS n_lines FROM d LEFT JOIN hits h ON h.route = d.route AND h.label = d.label GROUP BY d.route, d.label""")
def _(spark, sf):
    found = lines.section_lines(sections(spark, sf))
    dictionary = load_routing_config(spark, "char").unionByName(load_routing_config(spark, "prop")).where("section = 'keyword'")
    per_line = found.select(F.explode(F.array(*[
        F.struct(F.lit(r).alias("route"), lines.labels_of(F.col("line"), route_config(r)).alias("labels")) for r in ("char", "prop")
    ])).alias("h")).select("h.route", F.explode("h.labels").alias("label"))
    counts = per_line.groupBy("route", "label").agg(F.count(F.lit(1)).alias("n"))
    return dictionary.groupBy("route", "label").agg(F.count(F.lit(1)).alias("n_patterns")).join(
        counts, ["route", "label"], "left").select("route", "label", "n_patterns", F.coalesce("n", F.lit(0)).alias("n_lines"))


for _route in ("char", "prop"):
    def _labels(spark, sf, route=_route):
        return lines.label_lines(lines.section_lines(sections(spark, sf)), route).select(
            "doc_id", "chunk_index", "line_index", as_list("labels").alias("labels"))

    query(f"label_lines_{_route}", f"""WITH {SECTION_CTES} SELECT doc_id, chunk_index, i AS line_index, array_to_string(labels, '|') AS labels
FROM (SELECT *, {labels_sql('line', _route)} AS labels FROM section_lines) WHERE len(labels) > 0""")(_labels)


@query("process_signal_lines", f"""WITH {SECTION_CTES} SELECT * FROM (SELECT doc_id, chunk_index, i AS line_index,
  {any_regex(route_config('proc').keywords['actions'], 'line')} AS has_action, {any_regex(route_config('proc').keywords['materials'], 'line')} AS has_material,
  {any_regex(route_config('proc').keywords['support'], 'line')} AS has_support FROM section_lines) WHERE has_action OR has_material OR has_support""")
def _(spark, sf):
    return lines.process_signals(lines.section_lines(sections(spark, sf))).select(
        "doc_id", "chunk_index", "line_index", "has_action", "has_material", "has_support")


@query("match_terms", f"""WITH {SECTION_CTES}, {term_sql('prop').strip()}
SELECT l.doc_id, l.chunk_index, l.i AS line_index, t.sample_index, string_agg(DISTINCT t.label, '|' ORDER BY t.label) AS labels
FROM section_lines l JOIN fterms t ON t.doc_id = l.doc_id WHERE {hit_sql('l.line', 't.label', 'prop')} GROUP BY ALL""")
def _(spark, sf):
    return anchors.match_terms(lines.section_lines(sections(spark, sf)), anchors.family_terms(samples(spark, sf, "prop"), "prop")).select(
        "doc_id", "chunk_index", "line_index", "sample_index", as_list("labels").alias("labels"))


@query("form_mentions", f"WITH {SECTION_CTES} " + " UNION ALL ".join(
    f"""SELECT doc_id, chunk_index, '{r}' AS route, array_to_string(list_sort(f), '|') AS forms, array_to_string(list_sort({groups_sql('f')}), '|') AS form_groups
FROM (SELECT doc_id, chunk_index, {forms_sql('content', r)} AS f FROM sections)""" for r in ("char", "prop", "proc")))
def _(spark, sf):
    found = [F.struct(F.lit(r).alias("route"), anchors.form_mentions(F.col("content"), r).alias("forms")) for r in ("char", "prop", "proc")]
    return sections(spark, sf).select("doc_id", "chunk_index", F.explode(F.array(*found)).alias("f")).select(
        "doc_id", "chunk_index", "f.route", shown("f.forms").alias("forms"), shown(anchors.form_groups(F.col("f.forms"))).alias("form_groups"))


@query("ratio_conflicts", f"""WITH {route_base('char')},
r AS (SELECT a.doc_id, a.sample_index, s.chunk_index, a.ratios AS x, {ratios_sql('s.content')} AS y FROM anch a JOIN sections s USING (doc_id))
SELECT doc_id, sample_index, chunk_index, array_to_string(list_sort(y), '|') AS ratios, len(x) > 0 AND len(y) > 0 AND NOT list_has_any(x, y) AS conflict FROM r""")
def _(spark, sf):
    text = sections(spark, sf).select("run_id", "doc_id", "chunk_index", F.array_distinct(anchors.ratio_markers(F.col("content"))).alias("ratios"))
    smp = anchors.with_anchor_features(samples(spark, sf, "char"), "char").select("run_id", "doc_id", "sample_index", F.col("a.ratios").alias("own"))
    return smp.join(text, ["run_id", "doc_id"]).select("doc_id", "sample_index", "chunk_index", shown("ratios").alias("ratios"),
                                                      anchors.ratio_conflict(F.col("own"), F.col("ratios")).alias("conflict"))


@query("variant_flags", f"""WITH {route_base('prop')}, {SEGMENT_CTE.strip()},
h AS (SELECT a.doc_id, a.sample_index, l.chunk_index, l.segment, bool_or({hit_sql('l.text', 't.label', 'prop')}) AS hit,
  bool_or(CASE WHEN is_variant THEN {hit_sql('l.text', 't.label', 'prop')} ELSE {strong_sql('l.text', 't.label', 'prop')} END) AS strong
  FROM anch a JOIN segments l USING (doc_id) JOIN aterms t ON t.doc_id = a.doc_id AND t.sample_index = a.sample_index GROUP BY ALL)
SELECT h.doc_id, h.sample_index, h.chunk_index, h.segment, hit, strong, is_variant, {any_regex(vocab.VARIANT_MARKERS['prop'], 's.text')} AS marked
FROM h JOIN anch USING (doc_id, sample_index) JOIN segments s ON s.doc_id = h.doc_id AND s.chunk_index = h.chunk_index AND s.segment = h.segment""")
def _(spark, sf):
    smp = anchors.with_anchor_features(samples(spark, sf, "prop"), "prop")
    a = anchors.anchor_of(F.col("a"), "prop")
    rows = smp.join(lines.pseudo_heading_segments(sections(spark, sf)), ["run_id", "doc_id"])
    return rows.select(
        "doc_id", "sample_index", "chunk_index", "segment", anchors.any_term(F.col("text"), a.terms).alias("hit"),
        anchors.strong_hit(F.col("text"), a.terms, "prop", a.is_variant).alias("strong"), a.is_variant.alias("is_variant"),
        anchors.has_variant_marker(F.col("text"), "prop").alias("marked"))


# --- windows in DuckDB

def window_ctes(route: str, radius: int = windows.RESULT_RADIUS) -> str:
    """Result windows of a route as set operations: flags, focus, ranges, windows, ranking."""
    config = route_config(route)
    widen = (lambda x: x) if route == "char" else groups_sql
    rheo = sql_list((config.preferences or {}).get("PrecursorFluid", ()))
    excl = lambda t: any_regex(config.exclude, t)
    comp = lambda t: any_regex(config.comparative, t) if config.comparative else "false"
    transition = lambda t: any_regex(vocab.TRANSITIONS, t)
    marker = lambda t: any_regex(vocab.VARIANT_MARKERS["prop"], t) if route == "prop" else "false"
    if route == "char":
        focus = """CASE WHEN hit THEN NOT conflict ELSE family OR morph OR (is_caption AND near) END"""
        family = "NOT rconf AND shares AND fhit"
        morph = "list_contains(labels, 'Morphology') AND NOT is_fluid AND shares"
        variant, fluid, strong = "false", "false", "false"
        seed_rule, radius_rule, alone = "count(*) OVER () > 0", str(radius), "false"
        general = """NOT wconf AND ((len(family) > 0 AND wshares) OR (list_contains(keywords, 'Morphology') AND NOT is_fluid AND wshares))"""
        excluded = """derived OR (wexcl AND ((list_has_any(keywords, ['Morphology', 'BET']) AND wcomp AND NOT direct) OR NOT list_contains(keywords, 'Morphology') OR is_fluid))"""
        dropped = "false"
        hints = "CASE WHEN hit OR family OR (is_caption AND morph) THEN labels WHEN morph THEN ['Morphology'] ELSE [] END"
    else:
        focus = "CASE WHEN hit THEN NOT (NOT strong AND variant) AND NOT conflict ELSE family END"
        variant = "(NOT is_variant AND lmark AND fhit)"
        fluid = f"(is_fluid AND list_has_any(labels, [{rheo}]))"
        family = f"fhit AND NOT {variant} AND (NOT rconf OR {fluid}) AND (shares OR {fluid})"
        morph, strong = "false", "hit AND shit"
        seed_rule = "NOT (is_porous AND NOT is_variant AND bool_or(strong) OVER (PARTITION BY doc_id, sample_index, chunk_index)) OR strong"
        radius_rule = f"CASE WHEN (strong AND NOT is_variant) OR {fluid} THEN 1 ELSE {radius} END"
        alone = "strong AND NOT is_variant AND is_porous"
        wfluid = f"(len(family) > 0 AND is_fluid AND list_has_any({labels_sql('text', 'prop')}, [{rheo}]))"
        general = f"(NOT wconf OR {wfluid}) AND ((len(family) > 0 AND wshares) OR {wfluid}) AND NOT wvariant"
        excluded = "derived OR wexcl"
        dropped = "wvariant AND NOT wstrong"
        hints = "CASE WHEN hit OR family THEN labels ELSE [] END"
    return rf"""{route_base(route)},
segs AS (SELECT *, max(CASE WHEN i = 0 OR regexp_matches(line, '^\s*#') THEN i END) OVER (PARTITION BY doc_id, chunk_index ORDER BY i) AS seg_start FROM section_lines),
seg_ends AS (SELECT doc_id, chunk_index, i, seg_start, max(i) OVER (PARTITION BY doc_id, chunk_index, seg_start) AS seg_end FROM segs),
base AS (SELECT l.doc_id, l.chunk_index, l.i, l.line, l.labels, l.line_start, e.seg_start, e.seg_end, a.sample_index, a.is_fluid, a.is_variant,
    list_contains(a.agroups, 'PorousBody') AS is_porous, a.aforms, a.ratios, {forms_sql('l.line', route)} AS lf, {ratios_sql('l.line')} AS lr,
    regexp_matches(l.line, '{CAPTION}') OR regexp_matches(l.line, '^\s*#') AS is_caption, {excl('l.line')} AS lexcl, {comp('l.line')} AS lcomp, {marker('l.line')} AS lmark
  FROM labelled l JOIN roled r ON r.doc_id = l.doc_id AND r.chunk_index = l.chunk_index AND r.role = 'result'
  JOIN seg_ends e ON e.doc_id = l.doc_id AND e.chunk_index = l.chunk_index AND e.i = l.i JOIN anch a ON a.doc_id = l.doc_id),
ahit AS (SELECT b.doc_id, b.sample_index, b.chunk_index, b.i, bool_or({hit_sql('b.line', 't.label', route)}) AS hit,
    bool_or({"false" if route == "char" else "CASE WHEN is_variant THEN " + hit_sql('b.line', 't.label', route) + " ELSE " + strong_sql('b.line', 't.label', 'prop') + " END"}) AS shit
  FROM base b JOIN aterms t ON t.doc_id = b.doc_id AND t.sample_index = b.sample_index GROUP BY ALL),
fhits AS (SELECT b.doc_id, b.sample_index, b.chunk_index, b.i, bool_or({hit_sql('b.line', 't.label', route)}) AS fhit
  FROM base b JOIN fterms t ON t.doc_id = b.doc_id AND t.sample_index = b.sample_index GROUP BY ALL),
facts AS (SELECT b.*, hit, shit, fhit, len(aforms) > 0 AND list_has_any({widen('lf')}, aforms) AS shares,
    len(aforms) > 0 AND len(lf) > 0 AND NOT list_has_any({widen('lf')}, aforms) AS conflict,
    len(ratios) > 0 AND len(lr) > 0 AND NOT list_has_any(ratios, lr) AS rconf
  FROM base b JOIN ahit USING (doc_id, sample_index, chunk_index, i) JOIN fhits USING (doc_id, sample_index, chunk_index, i)),
near0 AS (SELECT f.doc_id, f.sample_index, f.chunk_index, f.i, any_value(f.aforms) AS aforms, any_value(f.ratios) AS ratios, string_agg(l.line, chr(10) ORDER BY l.i) AS text
  FROM facts f JOIN section_lines l ON l.doc_id = f.doc_id AND l.chunk_index = f.chunk_index
    AND l.i BETWEEN greatest(f.seg_start, f.i - {radius}) AND least(f.seg_end, f.i + {radius}) WHERE f.is_caption GROUP BY f.doc_id, f.sample_index, f.chunk_index, f.i),
near1 AS (SELECT *, {forms_sql('text', route)} AS tf, {ratios_sql('text')} AS tr FROM near0),
near2 AS (SELECT n.doc_id, n.sample_index, n.chunk_index, n.i,
    NOT (len(aforms) > 0 AND len(tf) > 0 AND NOT list_has_any({widen('tf')}, aforms)) AND (EXISTS (SELECT 1 FROM aterms t WHERE t.doc_id = n.doc_id AND t.sample_index = n.sample_index AND {hit_sql('n.text', 't.label', route)})
      OR (len(aforms) > 0 AND list_has_any({widen('tf')}, aforms) AND NOT (len(ratios) > 0 AND len(tr) > 0 AND NOT list_has_any(ratios, tr))
        AND EXISTS (SELECT 1 FROM fterms t WHERE t.doc_id = n.doc_id AND t.sample_index = n.sample_index AND {hit_sql('n.text', 't.label', route)}))) AS near
  FROM near1 n),
judged AS (SELECT f.*, coalesce(near, false) AS near, {strong} AS strong, {variant} AS variant, {family} AS family, {morph} AS morph
  FROM facts f LEFT JOIN near2 USING (doc_id, sample_index, chunk_index, i)),
focused AS (SELECT *, {focus} AS focus FROM judged),
kept0 AS (SELECT * FROM focused QUALIFY focus OR NOT bool_or(focus) OVER (PARTITION BY doc_id, sample_index, chunk_index)),
seeds AS (SELECT * FROM kept0 QUALIFY {seed_rule}),
rng AS (SELECT doc_id, sample_index, chunk_index, line_start, seg_start, greatest(seg_start, i - ({radius_rule})) AS s, least(seg_end, i + ({radius_rule})) AS e, {alone} AS alone, i FROM seeds),
flagged AS (SELECT *, CASE WHEN alone OR coalesce(s > max(e) OVER (PARTITION BY doc_id, sample_index, chunk_index, seg_start ORDER BY s, e, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, true) THEN 1 ELSE 0 END AS opens FROM rng),
ranged AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, sample_index, chunk_index ORDER BY s, e, i) AS window_index FROM flagged),
ranges AS (SELECT doc_id, sample_index, chunk_index, window_index, any_value(line_start) AS line_start, min(s) AS s, max(e) AS e FROM ranged GROUP BY ALL),
wtext AS (SELECT r.*, string_agg(l.line, chr(10) ORDER BY l.i) AS raw, trim(string_agg(concat(r.line_start + l.i, ': ', l.line), chr(10) ORDER BY l.i), '{WS}') AS text
  FROM ranges r JOIN section_lines l ON l.doc_id = r.doc_id AND l.chunk_index = r.chunk_index AND l.i BETWEEN r.s AND r.e GROUP BY r.doc_id, r.sample_index, r.chunk_index, r.window_index, r.line_start, r.s, r.e),
wlines AS (SELECT w.doc_id, w.sample_index, w.chunk_index, w.window_index, list_sort(list_distinct(flatten(list(f.labels)))) AS keywords,
    list_sort(list_distinct(flatten(list({hints})))) AS hints,
    {"bool_or(list_has_any(f.labels, ['Morphology', 'BET']) AND NOT (lexcl AND lcomp) AND (hit OR family OR morph) AND (is_caption OR NOT lexcl))" if route == "char" else "false"} AS direct
  FROM wtext w JOIN judged f ON f.doc_id = w.doc_id AND f.sample_index = w.sample_index AND f.chunk_index = w.chunk_index AND f.i BETWEEN w.s AND w.e GROUP BY ALL),
wanch AS (SELECT w.doc_id, w.sample_index, w.chunk_index, w.window_index, list_sort(list(t.label) FILTER ({hit_sql('w.raw', 't.label', route)})) AS anchors,
    {"false" if route == "char" else "bool_or(" + hit_sql('w.raw', 't.label', route) + " AND (a.is_variant OR " + strong_sql('w.text', 't.label', 'prop') + "))"} AS wstrong
  FROM wtext w JOIN aterms t ON t.doc_id = w.doc_id AND t.sample_index = w.sample_index JOIN anch a ON a.doc_id = w.doc_id AND a.sample_index = w.sample_index GROUP BY ALL),
wfam AS (SELECT w.doc_id, w.sample_index, w.chunk_index, w.window_index, list(t.label ORDER BY t.ord) FILTER ({hit_sql('w.text', 't.label', route)}) AS family
  FROM wtext w JOIN fterms t ON t.doc_id = w.doc_id AND t.sample_index = w.sample_index GROUP BY ALL),
wfacts AS (SELECT w.*, keywords, hints, direct, coalesce(anchors, []) AS anchors, coalesce(wstrong, false) AS wstrong, coalesce(family, []) AS family, a.is_fluid, a.is_variant, a.aforms, a.ratios, a.f0,
    {forms_sql('w.text', route)} AS tf, {ratios_sql('w.text')} AS tr, {excl('w.text')} AS wexcl, {comp('w.text')} AS wcomp, {transition('w.text')} AS wtrans, {marker('w.text')} AS wmark
  FROM wtext w JOIN wlines USING (doc_id, sample_index, chunk_index, window_index) LEFT JOIN wanch USING (doc_id, sample_index, chunk_index, window_index)
  LEFT JOIN wfam USING (doc_id, sample_index, chunk_index, window_index) JOIN anch a ON a.doc_id = w.doc_id AND a.sample_index = w.sample_index),
wjudged AS (SELECT *, len(ratios) > 0 AND len(tr) > 0 AND NOT list_has_any(ratios, tr) AS wconf, len(aforms) > 0 AND list_has_any({widen('tf')}, aforms) AS wshares,
    is_fluid AND len(tf) > 0 AND len(list_filter({widen('tf')}, lambda x: NOT list_contains(aforms, x))) > 0 AND wtrans AS derived,
    NOT is_variant AND len(family) > 0 AND wmark AS wvariant FROM wfacts),
wins AS (SELECT *, {excluded} AS excluded, {dropped} AS dropped, {general} AS general FROM wjudged),
raw_wins AS (SELECT * FROM wins WHERE NOT dropped),
ranked AS (SELECT * FROM (SELECT * FROM raw_wins WHERE NOT excluded) QUALIFY len(anchors) > 0 OR general OR NOT bool_or(len(anchors) > 0) OVER (PARTITION BY doc_id, sample_index))"""


def pairs(spark: SparkSession, sf: str, route: str) -> DataFrame:
    return windows.sample_sections(sections(spark, sf), samples(spark, sf, route), route)


def _windows(spark, sf, route):
    return windows.row_windows(pairs(spark, sf, route), route)


for _route in ("char", "prop"):
    def _seeds(spark, sf, route=_route):
        return windows.select_seeds(pairs(spark, sf, route), route).select(
            "doc_id", "sample_index", "chunk_index", "line_index", shown("labels").alias("labels"), "hit", "family")

    def _ranges(spark, sf, route=_route):
        return windows.seed_ranges(pairs(spark, sf, route), route).drop("run_id", "task_id")

    def _made(spark, sf, route=_route):
        return windows.build_windows(_windows(spark, sf, route)).where("kind = 'result'").select(
            "doc_id", "sample_index", "chunk_index", "window_index", "start", "end", as_list("keywords").alias("keywords"),
            as_list("anchors").alias("anchors"), as_list("family").alias("family"), "conflict", "excluded", "dropped", "general", "text")

    def _kept(spark, sf, route=_route):
        routed = windows.route_windows(_windows(spark, sf, route), route)
        rows = routed.where("NOT used_result_fallback").select("doc_id", "sample_index", F.explode(as_made("result")).alias("w")) if route == "char" else None
        if rows is None:
            # before hints narrow the keywords, the ranked windows are those of the rows
            all_rows = windows.build_windows(_windows(spark, sf, route)).where("kind = 'result' AND NOT dropped AND NOT excluded")
            flag = all_rows.groupBy("doc_id", "sample_index").agg(F.bool_or(F.size("anchors") > 0).alias("any_anchor"))
            kept = all_rows.join(flag, ["doc_id", "sample_index"]).where("NOT any_anchor OR size(anchors) > 0 OR general")
            return kept.select("doc_id", "sample_index", "chunk_index", "window_index", as_list("hints").alias("hints"))
        return rows.select("doc_id", "sample_index", "w.chunk_index", "w.window_index", as_list("w.hints").alias("hints"))

    query(f"select_seeds_{_route}", f"""WITH {window_ctes(_route)} SELECT doc_id, sample_index, chunk_index, i AS line_index,
array_to_string(list_sort(labels), '|') AS labels, hit, family FROM seeds""")(_seeds)
    query(f"context_ranges_{_route}", f'WITH {window_ctes(_route)} SELECT doc_id, sample_index, chunk_index, window_index, s AS start, e AS "end" FROM ranges')(_ranges)
    query(f"build_windows_{_route}", f"""WITH {window_ctes(_route)} SELECT doc_id, sample_index, chunk_index, window_index, line_start + s AS start, line_start + e AS "end",
array_to_string(keywords, '|') AS keywords, array_to_string(anchors, '|') AS anchors, array_to_string(family, '|') AS family, wconf AS conflict, excluded, dropped, general, text FROM wins""")(_made)
    query(f"rank_windows_{_route}", f"""WITH {window_ctes(_route)} SELECT doc_id, sample_index, chunk_index, window_index, array_to_string(hints, '|') AS hints FROM ranked""")(_kept)


# --- per-sample results

def routed(spark: SparkSession, sf: str, route: str) -> DataFrame:
    return windows.route_windows(_windows(spark, sf, route), route)


FULL = """
results AS (SELECT DISTINCT r.doc_id, a.sample_index, r.chunk_index, r.section_title, r.title_labels, r.content, r.line_start FROM roled r JOIN anch a USING (doc_id) WHERE r.role = 'result'),
raw_counts AS (SELECT a.doc_id, a.sample_index, count(w.window_index) AS raw_count FROM anch a LEFT JOIN raw_wins w ON w.doc_id = a.doc_id AND w.sample_index = a.sample_index GROUP BY ALL),
kept_counts AS (SELECT a.doc_id, a.sample_index, count(w.window_index) AS kept_count FROM anch a LEFT JOIN ranked w ON w.doc_id = a.doc_id AND w.sample_index = a.sample_index GROUP BY ALL)"""

CHAR_FINAL = f"""{window_ctes('char')},{FULL},
fulls AS (SELECT r.* FROM results r JOIN raw_counts c USING (doc_id, sample_index) WHERE c.raw_count = 0),
title_hits AS (SELECT r.doc_id, r.sample_index, r.chunk_index, unnest(r.title_labels) AS label FROM
  (SELECT r.*, a.aforms, a.is_fluid, a.f0, {forms_sql('r.content', 'char')} AS tf, {any_regex(vocab.TRANSITIONS, 'r.content')} AS trans FROM results r JOIN anch a USING (doc_id, sample_index) WHERE len(r.title_labels) > 0) r
  WHERE NOT (is_fluid AND len(tf) > 0 AND len(list_filter(tf, lambda x: NOT list_contains(aforms, x))) > 0 AND trans)
  AND (EXISTS (SELECT 1 FROM aterms t WHERE t.doc_id = r.doc_id AND t.sample_index = r.sample_index AND {hit_sql('r.content', 't.label', 'char')})
    OR (len(aforms) > 0 AND list_has_any(tf, aforms) AND EXISTS (SELECT 1 FROM fterms t WHERE t.doc_id = r.doc_id AND t.sample_index = r.sample_index AND {hit_sql('r.content', 't.label', 'char')}))
    OR (list_contains(r.title_labels, 'Morphology') AND NOT is_fluid AND len(aforms) > 0 AND list_has_any(tf, aforms)))),
all_hints AS (SELECT doc_id, sample_index, label FROM title_hits UNION SELECT doc_id, sample_index, unnest(hints) FROM ranked),
hint_lists AS (SELECT a.doc_id, a.sample_index, list_sort(list(h.label) FILTER (h.label IS NOT NULL)) AS hints FROM anch a LEFT JOIN all_hints h USING (doc_id, sample_index) GROUP BY ALL)"""


@query("result_fallback_char", f"""WITH {CHAR_FINAL} SELECT doc_id, sample_index, chunk_index, row_number() OVER (PARTITION BY doc_id, sample_index ORDER BY chunk_index) AS window_index,
array_to_string(title_labels, '|') AS keywords FROM fulls""")
def _(spark, sf):
    return routed(spark, sf, "char").where("used_result_fallback").select("doc_id", "sample_index", F.explode(as_made("result")).alias("w")).select(
        "doc_id", "sample_index", "w.chunk_index", "w.window_index", as_list("w.keywords").alias("keywords"))


@query("method_hints_char", f"WITH {CHAR_FINAL} SELECT doc_id, sample_index, coalesce(array_to_string(hints, '|'), '') AS hints FROM hint_lists")
def _(spark, sf):
    return routed(spark, sf, "char").select("doc_id", "sample_index", as_list("hints").alias("hints"))


METHODS = """
mrng AS (SELECT l.doc_id, l.chunk_index, l.line_start, e.seg_start, greatest(e.seg_start, l.i - 4) AS s, least(e.seg_end, l.i + 4) AS e, l.i, r.section_title
  FROM labelled l JOIN roled r ON r.doc_id = l.doc_id AND r.chunk_index = l.chunk_index AND r.role = 'method' JOIN seg_ends e ON e.doc_id = l.doc_id AND e.chunk_index = l.chunk_index AND e.i = l.i),
mopen AS (SELECT *, CASE WHEN coalesce(s > max(e) OVER (PARTITION BY doc_id, chunk_index, seg_start ORDER BY s, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, true) THEN 1 ELSE 0 END AS opens FROM mrng),
mwin AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, chunk_index ORDER BY s, i) AS window_index FROM mopen),
mranges AS (SELECT doc_id, chunk_index, window_index, any_value(section_title) AS section_title, min(s) AS s, max(e) AS e, any_value(line_start) AS line_start FROM mwin GROUP BY ALL),
mkeys AS (SELECT m.doc_id, m.chunk_index, m.window_index, any_value(m.section_title) AS section_title, any_value(m.line_start + m.s) AS start, any_value(m.line_start + m.e) AS "end",
  list_sort(list_distinct(flatten(list(l.labels)))) AS keywords FROM mranges m JOIN labelled l ON l.doc_id = m.doc_id AND l.chunk_index = m.chunk_index AND l.i BETWEEN m.s AND m.e GROUP BY m.doc_id, m.chunk_index, m.window_index)"""


@query("method_excerpts_char", f"""WITH {CHAR_FINAL},{METHODS}
SELECT m.doc_id, h.sample_index, m.chunk_index, m.window_index, m.start, m."end", array_to_string(list_filter(m.keywords, lambda x: list_contains(h.hints, x)), '|') AS keywords
FROM mkeys m JOIN hint_lists h USING (doc_id) WHERE list_has_any(m.keywords, h.hints)""")
def _(spark, sf):
    return routed(spark, sf, "char").select("doc_id", "sample_index", F.explode(as_made("methods")).alias("w")).select(
        "doc_id", "sample_index", "w.chunk_index", "w.window_index", "w.start", "w.end", as_list("w.keywords").alias("keywords"))


def task_summary(built: DataFrame, first: str, second: str, flag: str) -> DataFrame:
    return built.select("doc_id", "sample_index", "task_id", F.col(f"route_stats.{first}").alias(first),
                        F.col(f"route_stats.{second}").alias(second), F.col(f"route_stats.{flag}").alias(flag))


CHAR_TASKS = f"""{CHAR_FINAL},{METHODS},
mcount AS (SELECT h.doc_id, h.sample_index, count(m.window_index) AS n FROM hint_lists h LEFT JOIN mkeys m ON m.doc_id = h.doc_id AND list_has_any(m.keywords, h.hints) GROUP BY ALL),
fcount AS (SELECT doc_id, sample_index, count(*) AS n FROM fulls GROUP BY ALL),
tasks AS (SELECT doc_id, sample_index, concat('run__', doc_id, '__', lpad(sample_index::varchar, 3, '0'), '__characterization') AS task_id, m.n AS method_window_count,
  kept_count + coalesce(f.n, 0) AS result_window_count, coalesce(f.n, 0) > 0 AS used_result_fallback
  FROM mcount m JOIN kept_counts USING (doc_id, sample_index) LEFT JOIN fcount f USING (doc_id, sample_index))"""


@query("char_tasks", f"WITH {CHAR_TASKS} SELECT * FROM tasks")
def _(spark, sf):
    built = tasks.build_char_tasks(sections(spark, sf), samples(spark, sf, "char"))
    return task_summary(built, "method_window_count", "result_window_count", "used_result_fallback")


@query("char_task_stats", f"""WITH {CHAR_TASKS} SELECT 'task_count' AS metric, count(*) AS value FROM tasks UNION ALL SELECT 'empty_method_count', count(*) FILTER (method_window_count = 0) FROM tasks
UNION ALL SELECT 'empty_result_count', count(*) FILTER (result_window_count = 0) FROM tasks UNION ALL SELECT 'empty_context_count', count(*) FILTER (method_window_count = 0 AND result_window_count = 0) FROM tasks
UNION ALL SELECT 'fallback_count', count(*) FILTER (used_result_fallback) FROM tasks""")
def _(spark, sf):
    return stats.route_before_stats(tasks.build_char_tasks(sections(spark, sf), samples(spark, sf, "char")), "char")


# the task text is put together again from the parts of the task's own windows
@query("char_task_text", f"""WITH {CHAR_TASKS},
wtexts AS (SELECT doc_id, sample_index, count(*) AS n, sum(len(text)) AS n_chars FROM ranked GROUP BY ALL)
SELECT t.doc_id, t.sample_index, concat('[RESULT_METHOD_HINTS]', CASE WHEN len(hints) > 0 THEN chr(10) || array_to_string(hints, ', ') ELSE '' END) AS hint_block,
  t.result_window_count AS n_excerpts FROM tasks t JOIN hint_lists h USING (doc_id, sample_index)""")
def _(spark, sf):
    built = tasks.build_char_tasks(sections(spark, sf), samples(spark, sf, "char"))
    blocks = F.split("text", r"\n\n\[CHAR_RESULTS\]")
    return built.select(
        "doc_id", "sample_index",
        F.regexp_extract("text", r"(?s)(\[RESULT_METHOD_HINTS\].*?)\n\n\[CHAR_METHODS\]", 1).alias("hint_block"),
        F.size(F.regexp_extract_all(blocks[1], F.lit(r"(?m)^## excerpt \d+ \| block="), F.lit(0))).alias("n_excerpts"))


PROP = route_config("prop")
PREFERRED = "list_distinct(flatten(list_transform(agroups, lambda g: CASE " + " ".join(
    f"WHEN g = '{k}' THEN [{sql_list(v)}]" for k, v in PROP.preferences.items()) + " ELSE [] END)))"


# the porous fallback has windows of its own, with the smaller radius; title phrases make property sections
PROP_FINAL = f"""{window_ctes('prop')},{FULL},
porous_wins AS (WITH {window_ctes('prop', windows.POROUS_FALLBACK_RADIUS)} SELECT doc_id, sample_index, chunk_index, window_index, line_start, s, e, keywords, hints FROM raw_wins WHERE NOT excluded),
state AS (SELECT a.doc_id, a.sample_index, agroups, raw_count, kept_count, list_contains(agroups, 'PorousBody') AS porous FROM anch a JOIN raw_counts USING (doc_id, sample_index) JOIN kept_counts USING (doc_id, sample_index)),
porous_kept AS (SELECT p.doc_id, p.sample_index, chunk_index, window_index, line_start + s AS start, line_start + e AS "end", 'prop_results' AS part, list_filter(keywords, lambda x: x IN ({sql_list(PROP.preferences['PorousBody'])})) AS keywords, hints
  FROM porous_wins p JOIN state USING (doc_id, sample_index) WHERE kept_count = 0 AND raw_count > 0 AND porous AND list_has_any(keywords, [{sql_list(PROP.preferences['PorousBody'])}])),
full_lines AS (SELECT doc_id, sample_index, chunk_index, list_distinct(flatten(list(labels))) AS labels, list_distinct(flatten(list(CASE WHEN hit OR family THEN labels ELSE [] END))) AS hints FROM judged GROUP BY ALL),
full_kept AS (SELECT r.doc_id, r.sample_index, r.chunk_index, row_number() OVER (PARTITION BY r.doc_id, r.sample_index ORDER BY r.chunk_index) AS window_index, s.line_start AS start, s.line_end AS "end", 'prop_results_full' AS part,
    list_sort(list_distinct(list_concat(coalesce(r.title_labels, []), coalesce(l.labels, [])))) AS keywords, coalesce(l.hints, []) AS hints
  FROM results r JOIN state t USING (doc_id, sample_index) JOIN sections s USING (doc_id, chunk_index) LEFT JOIN full_lines l USING (doc_id, sample_index, chunk_index)
  WHERE t.raw_count = 0 AND len(r.title_labels) > 0),
chosen AS (SELECT doc_id, sample_index, chunk_index, window_index, line_start + s AS start, line_start + e AS "end", 'prop_results' AS part, keywords, hints FROM ranked UNION ALL SELECT * FROM porous_kept UNION ALL SELECT * FROM full_kept),
direct AS (SELECT a.doc_id, a.sample_index, a.agroups, list_sort(list_distinct(flatten(list(coalesce(c.hints, []))))) AS found, count(c.window_index) AS n FROM anch a LEFT JOIN chosen c USING (doc_id, sample_index) GROUP BY ALL),
hint_lists AS (SELECT d.doc_id, d.sample_index, d.n > 0 AND t.kept_count = 0 AS used_result_fallback,
    CASE WHEN list_has_any(found, {PREFERRED.replace("agroups", "d.agroups")}) THEN list_filter(found, lambda x: list_contains({PREFERRED.replace("agroups", "d.agroups")}, x)) ELSE found END AS hints
  FROM direct d JOIN state t USING (doc_id, sample_index)),
narrowed AS (SELECT c.*, CASE WHEN len(h.hints) > 0 THEN list_filter(c.keywords, lambda x: list_contains(h.hints, x)) ELSE c.keywords END AS cut FROM chosen c JOIN hint_lists h USING (doc_id, sample_index)
  WHERE len(h.hints) = 0 OR list_has_any(c.keywords, h.hints))"""

PROP_METHODS = f"""{METHODS},
agreeing AS (SELECT h.doc_id, h.sample_index, m.chunk_index, m.window_index, m.start, m."end", list_filter(m.keywords, lambda x: list_contains(h.hints, x)) AS keywords, 'prop_methods' AS part
  FROM mkeys m JOIN hint_lists h USING (doc_id) JOIN roled r ON r.doc_id = m.doc_id AND r.chunk_index = m.chunk_index
  WHERE list_has_any(m.keywords, h.hints) AND (len(r.title_labels) = 0 OR list_has_any(r.title_labels, h.hints))),
whole AS (SELECT h.doc_id, h.sample_index, r.chunk_index, row_number() OVER (PARTITION BY h.doc_id, h.sample_index ORDER BY r.chunk_index) AS window_index, s.line_start AS start, s.line_end AS "end",
    list_sort(list_distinct(list_concat(r.title_labels, coalesce(l.labels, [])))) AS keywords, 'prop_methods_full' AS part
  FROM roled r JOIN hint_lists h USING (doc_id) JOIN sections s USING (doc_id, chunk_index)
  LEFT JOIN (SELECT doc_id, chunk_index, flatten(list(labels)) AS labels FROM labelled GROUP BY ALL) l USING (doc_id, chunk_index)
  WHERE r.role = 'method' AND list_has_any(r.title_labels, h.hints) AND NOT EXISTS (SELECT 1 FROM agreeing g WHERE g.doc_id = h.doc_id AND g.sample_index = h.sample_index)),
excerpts AS (SELECT * FROM agreeing UNION ALL SELECT * FROM whole)"""


@query("method_hints_prop", f"WITH {PROP_FINAL} SELECT doc_id, sample_index, used_result_fallback, coalesce(array_to_string(hints, '|'), '') AS hints FROM hint_lists")
def _(spark, sf):
    return routed(spark, sf, "prop").select("doc_id", "sample_index", "used_result_fallback", as_list("hints").alias("hints"))


@query("result_windows_prop", f"""WITH {PROP_FINAL} SELECT doc_id, sample_index, chunk_index, window_index, start, "end", array_to_string(cut, '|') AS keywords FROM narrowed""")
def _(spark, sf):
    return routed(spark, sf, "prop").select("doc_id", "sample_index", F.explode(as_made("result")).alias("w")).select(
        "doc_id", "sample_index", "w.chunk_index", "w.window_index", "w.start", "w.end", as_list("w.keywords").alias("keywords"))


@query("method_excerpts_prop", f"""WITH {PROP_FINAL},{PROP_METHODS} SELECT doc_id, sample_index, chunk_index, window_index, start, "end", array_to_string(keywords, '|') AS keywords FROM excerpts""")
def _(spark, sf):
    return routed(spark, sf, "prop").select("doc_id", "sample_index", F.explode(as_made("methods")).alias("w")).select(
        "doc_id", "sample_index", "w.chunk_index", "w.window_index", "w.start", "w.end", as_list("w.keywords").alias("keywords"))


@query("prop_tasks", f"""WITH {PROP_FINAL},{PROP_METHODS} SELECT h.doc_id, h.sample_index, concat('run__', h.doc_id, '__', lpad(h.sample_index::varchar, 3, '0'), '__property') AS task_id,
  (SELECT count(*) FROM excerpts x WHERE x.doc_id = h.doc_id AND x.sample_index = h.sample_index) AS method_window_count,
  (SELECT count(*) FROM narrowed x WHERE x.doc_id = h.doc_id AND x.sample_index = h.sample_index) AS result_window_count, used_result_fallback FROM hint_lists h""")
def _(spark, sf):
    built = tasks.build_prop_tasks(sections(spark, sf), samples(spark, sf, "prop"))
    return task_summary(built, "method_window_count", "result_window_count", "used_result_fallback")


@query("window_refs_char", f"""WITH {CHAR_TASKS}
SELECT doc_id, sample_index, chunk_index, 'char_methods' AS route_role, window_index, start AS line_start, "end" AS line_end FROM (SELECT m.*, h.sample_index FROM mkeys m JOIN hint_lists h USING (doc_id) WHERE list_has_any(m.keywords, h.hints))
UNION ALL SELECT doc_id, sample_index, chunk_index, 'char_results', window_index, line_start + s, line_start + e FROM ranked
UNION ALL SELECT f.doc_id, f.sample_index, f.chunk_index, 'char_results_full', row_number() OVER (PARTITION BY f.doc_id, f.sample_index ORDER BY f.chunk_index), s.line_start, s.line_end FROM fulls f JOIN sections s USING (doc_id, chunk_index)""")
def _(spark, sf):
    built = tasks.build_char_tasks(sections(spark, sf), samples(spark, sf, "char"))
    return built.select("doc_id", "sample_index", F.explode(as_made("source_refs")).alias("r")).select(
        "doc_id", "sample_index", "r.chunk_index", "r.route_role", "r.window_index",
        F.col("r.line_span")[0].alias("line_start"), F.col("r.line_span")[1].alias("line_end"))


# --- process route

PC = route_config("proc")


def _title_sql(kind: str) -> str:
    phrases = " OR ".join(f"contains(lower(segment_title), '{p}')" for p in PC.segment_phrases[kind])
    return f"({phrases} OR {any_regex(PC.segment_patterns[kind], 'segment_title')})"


UPSTREAM = "list_distinct(list_concat(agroups, flatten(list_transform(agroups, lambda g: CASE " + " ".join(
    f"WHEN g = '{k}' THEN [{sql_list(v)}]" for k, v in PC.preferences.items()) + " ELSE [] END))))"
PROC_CTES = f"""{route_base('proc')},{SEGMENT_CTE},
seg0 AS (SELECT s.*, r.role, {_title_sql('include')} AS process_title, {any_regex(PC.keywords['actions'], 'text')} AS action,
    {any_regex(PC.keywords['materials'], 'segment_title')} OR {any_regex(PC.keywords['materials'], 'text')} AS material, {any_regex(PC.keywords['support'], 'text')} AS support,
    {any_regex(vocab.VARIANT_MARKERS['proc'], 'text')} AS marked, {groups_sql(forms_sql('segment_title', 'proc'))} AS title_forms, {groups_sql(forms_sql("concat(segment_title, ' ', text)", 'proc'))} AS all_forms
  FROM segments s JOIN roled r USING (doc_id, chunk_index) WHERE r.role IN ('method', 'support', 'method_support', 'front') AND text <> ''),
seg1 AS (SELECT *, CASE WHEN len(title_forms) > 0 THEN title_forms ELSE all_forms END AS forms, NOT process_title AND {_title_sql('exclude')} AS excl FROM seg0),
pairs AS (SELECT g.*, a.sample_index, a.is_variant, a.agroups, {UPSTREAM} AS allowed FROM seg1 g JOIN anch a USING (doc_id)),
phit AS (SELECT p.doc_id, p.sample_index, p.chunk_index, p.segment, list(t.label ORDER BY t.ord) FILTER ({hit_sql('p.text', 't.label', 'proc')}) AS anchors,
    bool_or(CASE WHEN is_variant THEN {hit_sql('p.text', 't.label', 'proc')} ELSE {strong_sql('p.text', 't.label', 'proc')} END) AS strong
  FROM pairs p JOIN aterms t ON t.doc_id = p.doc_id AND t.sample_index = p.sample_index GROUP BY ALL),
pfam AS (SELECT p.doc_id, p.sample_index, p.chunk_index, p.segment, list(t.label ORDER BY t.ord) FILTER ({hit_sql('p.text', 't.label', 'proc')}) AS families
  FROM pairs p JOIN fterms t ON t.doc_id = p.doc_id AND t.sample_index = p.sample_index GROUP BY ALL),
judged AS (SELECT p.*, anchors, families, anchors IS NOT NULL AS hit, families IS NOT NULL AS family, strong, NOT is_variant AND families IS NOT NULL AND marked AS variant,
    list_has_any(forms, allowed) AS upstream, list_contains(forms, 'SupportedNode') AND (strong OR families IS NOT NULL) AS node, len(forms) = 0 AND len(agroups) > 0 AS formless
  FROM pairs p JOIN phit USING (doc_id, sample_index, chunk_index, segment) JOIN pfam USING (doc_id, sample_index, chunk_index, segment)),
uses AS (
  SELECT *, 'method' AS use FROM judged WHERE role IN ('method', 'method_support') AND NOT excl AND (process_title OR action OR material OR hit)
    AND (strong OR (NOT variant AND upstream AND (family OR process_title OR action)))
  UNION ALL SELECT *, 'material' FROM judged WHERE role IN ('method', 'method_support') AND NOT excl AND material
  UNION ALL SELECT *, 'support' FROM judged WHERE role IN ('support', 'method_support') AND (NOT excl OR node) AND (process_title OR action OR support OR node)
    AND (strong OR (NOT variant AND family AND (upstream OR formless)))
  UNION ALL SELECT *, 'weak' FROM judged WHERE role = 'front' AND (hit OR family) AND (action OR support OR upstream OR formless) AND (strong OR NOT variant)),
chosen AS (SELECT *, bool_or(use = 'method') OVER w AS has_method, bool_or(use = 'support') OVER w AS has_support FROM uses WINDOW w AS (PARTITION BY doc_id, sample_index)),
final AS (SELECT *, CASE WHEN use IN ('method', 'material') THEN 'process_methods' ELSE 'process_support' END AS route_role FROM chosen
  WHERE use IN ('method', 'support') OR (use = 'material' AND NOT has_method) OR (use = 'weak' AND NOT has_support))"""


def judged_segments(spark: SparkSession, sf: str) -> DataFrame:
    return segments.judged_segments(segments.sample_segments(sections(spark, sf), samples(spark, sf, "proc")))


for _use in ("method", "support", "weak"):
    def _segments(spark, sf, use=_use):
        rows = segments.dedupe_excerpts(segments.segment_rows(judged_segments(spark, sf)))
        return rows.where(F.col("use") == use).select(
            "doc_id", "sample_index", "chunk_index", "segment_title", "start", "end", as_list("anchors").alias("anchors"),
            as_list("families").alias("families"), as_list("forms").alias("forms"), "text")

    query(f"process_{_use}_segments", f"""WITH {PROC_CTES} SELECT doc_id, sample_index, chunk_index, segment_title, line_start + start AS start, line_start + stop - 1 AS "end",
coalesce(array_to_string(anchors, '|'), '') AS anchors, coalesce(array_to_string(families, '|'), '') AS families, array_to_string(list_sort(forms), '|') AS forms, text FROM uses WHERE use = '{_use}'""")(_segments)


@query("proc_source_refs", f"""WITH {PROC_CTES} SELECT doc_id, sample_index, chunk_index, route_role, segment_title, line_start + start AS line_start, line_start + stop - 1 AS line_end FROM final""")
def _(spark, sf):
    return tasks.build_proc_tasks(sections(spark, sf), samples(spark, sf, "proc")).select(
        "doc_id", "sample_index", F.explode(as_made("source_refs")).alias("r")).select(
        "doc_id", "sample_index", "r.chunk_index", "r.route_role", "r.segment_title",
        F.col("r.line_span")[0].alias("line_start"), F.col("r.line_span")[1].alias("line_end"))


PROC_TASKS = f"""{PROC_CTES},
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, sample_index, route_role ORDER BY chunk_index, start) AS k FROM final),
texts AS (SELECT doc_id, sample_index, route_role, string_agg(trim(concat_ws(chr(10), '## excerpt ' || k, 'section_title: ' || section_title, 'segment_title: ' || segment_title,
    concat('line_span: ', line_start + start, '-', line_start + stop - 1), text), '{WS}'), chr(10) || chr(10) ORDER BY k) AS body, count(*) AS n, bool_or(use = 'material') AS fallback FROM ranked GROUP BY ALL),
tasks AS (SELECT s.doc_id, s.sample_index, s.sample_id, concat('run__', s.doc_id, '__', lpad(s.sample_index::varchar, 3, '0'), '__process') AS task_id,
    coalesce(m.n, 0) AS method_excerpt_count, coalesce(p.n, 0) AS support_excerpt_count, coalesce(m.fallback, false) AS used_method_fallback,
    trim(concat('[POLYMER_ANCHOR]', chr(10), trim(concat('身份标识: ', s.sample_id, chr(10), '名称: ', s.name, chr(10), '别名: ', chr(10), '聚合物分类编码: ', s.category_code, chr(10), '聚合物分类名称: ', coalesce(s.category_name, ''), chr(10), '样本形态: ', s.sample_form), '{WS}'),
      chr(10), chr(10), '[PROCESS_METHODS]', chr(10), coalesce(chr(10) || m.body, ''), chr(10), chr(10), '[PROCESS_SUPPORT]', chr(10), coalesce(chr(10) || p.body, '')), '{WS}') AS text
  FROM smp s LEFT JOIN texts m ON m.doc_id = s.doc_id AND m.sample_index = s.sample_index AND m.route_role = 'process_methods'
  LEFT JOIN texts p ON p.doc_id = s.doc_id AND p.sample_index = s.sample_index AND p.route_role = 'process_support')"""


@query("proc_tasks", f"WITH {PROC_TASKS} SELECT doc_id, sample_index, sample_id, task_id, method_excerpt_count, support_excerpt_count, used_method_fallback, text FROM tasks")
def _(spark, sf):
    built = tasks.build_proc_tasks(sections(spark, sf), samples(spark, sf, "proc"))
    return built.select("doc_id", "sample_index", "sample_id", "task_id", "route_stats.*", "text")

"""Section roles and the text that goes to the first model call of each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.arrays import let
from scholion.functions.text import any_pattern, any_phrase, collapse, strip
from scholion.sources.routing_config import RouteConfig, route_config

# Title phrases that name the parts of a paper.
INTRO = ("INTRODUCT", "引言", "绪论")
EXPERIMENT = ("MATERIALS AND METHODS", "MATERIALS & METHODS", "MATERIALS AND METHOD", "EXPERIMENTAL", "EXPERIMENT",
              "METHODS", "METHODOLOGY")
RESULTS = ("RESULTS AND DISCUSSION", "RESULTS", "DISCUSSION")
CONCLUSION = ("CONCLUSION", "CONCLUSIONS")


def title_key(title: Column) -> Column:
    return F.upper(collapse(title))


def main_roles(title: Column, number: Column) -> dict[str, Column]:
    key = title_key(title)
    return {
        "is_body": number.isNotNull() | any_phrase(key, INTRO + EXPERIMENT + RESULTS + CONCLUSION),
        "is_experiment": any_phrase(key, EXPERIMENT) | (key == "MATERIALS"),
        "is_results": any_phrase(key, RESULTS),
    }


def keyword_title(key: Column, config: RouteConfig) -> Column:
    return any_pattern(key, [p for ps in config.keywords.values() for p in ps])


def route_role(title: Column, chunk_index: Column, route: str) -> Column:
    """Role of a section in a route: method, result, support, front, other or ignore."""
    config = route_config(route)
    key = title_key(title)
    ignore = any_phrase(key, config.titles["ignore"])
    method = any_phrase(key, config.titles["method"])
    if route == "proc":
        support = any_phrase(key, config.titles["support"])
        return (
            F.when(ignore, "ignore").when(method & support, "method_support").when(method, "method")
            .when(support, "support").when(chunk_index == 0, "front").otherwise("other")
        )
    result = any_phrase(key, config.titles["result"])
    named = keyword_title(key, config)
    if route == "char":
        return (F.when(ignore, "ignore").when(method, "method").when(result | named, "result").otherwise("other"))
    return (
        F.when(ignore, "ignore").when(method, "method").when((chunk_index == 0) & ~result, "front")
        .when(result | named, "result").otherwise("other")
    )


def classify_sections(sections: DataFrame, route: str) -> DataFrame:
    """Sections with their role; ``main`` gives three flags instead of one role."""
    if route == "main":
        flags = main_roles(F.col("section_title"), F.col("section_number"))
        return sections.withColumns(flags)
    out = sections.withColumn("role", route_role(F.col("section_title"), F.col("chunk_index"), route))
    if route == "prop":
        out = out.withColumn("property_title", (F.col("role") != "ignore")
                             & keyword_title(title_key(F.col("section_title")), route_config(route)))
    return out


DOC_KEYS = ["run_id", "doc_id"]


def file_keys(df: DataFrame) -> list[str]:
    """Columns that tell files apart; files of equal content share ``doc_id``."""
    return [*DOC_KEYS, *[c for c in ("doc_index",) if c in df.columns]]


def document_parts(sections: DataFrame) -> DataFrame:
    """Per document: the sections its first task needs, as arrays ordered by position.

    Positions of the experiment, results and first body section come from map-side
    minima. Only sections that the task text keeps are gathered; one document's
    task text is the size bound of a group.
    """
    flagged = classify_sections(sections, "main")
    at = F.col("chunk_index")
    keys = file_keys(sections)
    firsts = flagged.groupBy(*keys).agg(
        F.min(at).alias("first_at"),
        F.min("file_name").alias("file_name"),
        F.min(F.when(F.col("is_experiment"), at)).alias("experiment_at"),
        F.min(F.when(F.col("is_results"), at)).alias("results_at"),
        F.min(F.when(F.col("is_body") & (at > 0), at)).alias("body_at"),
    )
    stop = F.coalesce(F.col("body_at"), F.col("first_at") + 1)
    joined = flagged.drop("file_name").join(firsts, keys)
    roles = F.array_compact(F.array(
        F.when(at == F.col("first_at"), F.lit("title")),
        F.when(at < stop, F.lit("front_matter")),
        F.when(at == F.col("experiment_at"), F.lit("experimental")),
        F.when(at == F.col("results_at"), F.lit("results")),
    ))
    return (
        joined.withColumn("roles", roles).where(F.size("roles") > 0)
        .groupBy(*keys, "file_name")
        .agg(F.array_sort(F.collect_list(F.struct(
            "chunk_index", "block_id", "section_title", "line_span", "roles", "content"))).alias("parts"))
    )


def _texts(parts: Column, role: str) -> Column:
    kept = F.filter(parts, lambda p: F.array_contains(p["roles"], role) & (strip(p["content"]) != ""))
    return strip(F.array_join(F.transform(kept, lambda p: strip(p["content"])), "\n\n"))


def render_tagged_text(parts: Column) -> Column:
    """Tagged blocks of front matter, experiment and results; empty ones are left out."""
    tags = [("FRONT_MATTER", "front_matter"), ("EXPERIMENT", "experimental"), ("RESULTS", "results")]
    blocks = [F.concat(F.lit(f"[{tag}]\n"), F.nullif(_texts(parts, role), F.lit(""))) for tag, role in tags]
    return strip(F.concat_ws("\n\n", *blocks))


def front_matter(sections: DataFrame) -> DataFrame:
    """Sections before the first body section; only the first one when there is none."""
    return _parts_with(sections, "front_matter")


def first_section(sections: DataFrame, role: str) -> DataFrame:
    """The earliest ``experimental`` or ``results`` section of each document."""
    return _parts_with(sections, role)


def _parts_with(sections: DataFrame, role: str) -> DataFrame:
    return (
        document_parts(sections).select(*DOC_KEYS, F.explode("parts").alias("p"))
        .where(F.array_contains("p.roles", role)).select(*DOC_KEYS, "p.*").drop("roles")
    )


def source_refs(parts: Column) -> Column:
    return F.transform(parts, lambda p: p.dropFields("content"))


def build_main_signal_tasks(sections: DataFrame) -> DataFrame:
    """One task per document: text for the model and where it came from."""
    return document_parts(sections).select(
        *DOC_KEYS,
        F.concat_ws("__", "run_id", "doc_id", F.lit("main_signal")).alias("task_id"),
        "file_name",
        source_refs(F.col("parts")).alias("source_refs"),
        render_tagged_text(F.col("parts")).alias("text"),
    )


# --- first generation

def _v1_block(c: Column) -> Column:
    return F.concat(F.lit("# "), c["content_title"], F.lit("\n"), c["content"])


def _v1_chunks(chunks: DataFrame, keys: list[str]) -> DataFrame:
    return chunks.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(
        "chunk_index", "content_title", "content"))).alias("chunks"))


def paper_context_v1(chunks: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Title, abstract and experiment text of a paper.

    The abstract is all text before the introduction. The experiment part opens at the
    first experiment chunk from there on and goes on while titles begin with the same
    character.
    """
    def upper_has(c: Column, word: str) -> Column:
        return F.upper(c["content_title"]).contains(word)

    def experiment(cs: Column) -> Column:
        tail = F.slice(cs, F.coalesce(_first_at(cs, lambda c: upper_has(c, "INTRODUCT")), F.size(cs)) + 1, F.size(cs))
        return let(tail, lambda t: let(
            _first_at(t, lambda c: upper_has(c, "EXPERIM")),
            lambda at: F.when(at.isNull(), "").otherwise(let(
                F.slice(t, at + 1, F.size(t)),
                lambda run: let(
                    F.coalesce(_first_at(run, lambda c: (strip(c["content_title"]) == "") | (
                        F.substring(strip(c["content_title"]), 1, 1)
                        != F.substring(strip(F.get(run, F.lit(0))["content_title"]), 1, 1)), skip=1), F.size(run)),
                    lambda stop: F.array_join(F.transform(F.slice(run, 1, stop), _v1_block), "\n\n")),
            )),
        ))

    def abstract(cs: Column) -> Column:
        stop = F.coalesce(_first_at(cs, lambda c: upper_has(c, "INTRODUCT")), F.size(cs))
        return F.array_join(F.transform(F.slice(cs, 1, stop), _v1_block), "\n\n")

    first = F.get("chunks", F.lit(0))
    return _v1_chunks(chunks, list(keys)).select(
        *keys,
        F.concat(F.lit("# "), first["content_title"]).alias("title"),
        abstract(F.col("chunks")).alias("abstract"),
        experiment(F.col("chunks")).alias("experiment"),
    )


def _first_at(items: Column, test, skip: int = 0) -> Column:
    """Zero-based position of the first item (from ``skip`` on) that passes, else null."""
    hits = F.transform(items, lambda c, i: F.when((i >= skip) & test(c), i))
    return F.array_min(F.array_compact(hits))


def section_bundles_v1(chunks: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Three text bundles per paper.

    ``effective_section`` leaves out references; ``specific_section`` also the opening
    chunk, introduction and abstract; ``result_and_discussion`` repeats, for each result
    chunk, all chunks after it up to a conclusion, acknowledgement or reference.
    """
    def has(c: Column, *words: str) -> Column:
        return any_phrase(F.upper(c["content_title"]), words)

    def followers(cs: Column, i: Column) -> Column:
        rest = F.slice(cs, i + 2, F.size(cs))
        return let(rest, lambda r: F.slice(r, 1, F.coalesce(
            _first_at(r, lambda c: has(c, "CONCLUSION", "ACKNOWLEDGEMENT", "REFERENCE")), F.size(r))))

    def results(cs: Column) -> Column:
        return F.flatten(F.transform(cs, lambda c, i: F.when(
            has(c, "RESULTS", "DISCUSSION", "CONCLUSION"), F.concat(F.array(c), followers(cs, i)))
            .otherwise(F.slice(cs, 1, 0))))

    def text(cs: Column) -> Column:
        return F.array_join(F.transform(cs, _v1_block), "\n\n")

    cs = F.col("chunks")
    kept = F.filter(cs, lambda c: ~has(c, "REFERENCE"))
    first_at = F.get(cs, F.lit(0))["chunk_index"]
    return _v1_chunks(chunks, list(keys)).select(
        *keys,
        text(kept).alias("effective_section"),
        text(F.filter(kept, lambda c: (c["chunk_index"] != first_at) & ~has(c, "INTRODUCTION", "ABSTRACT")))
        .alias("specific_section"),
        text(results(cs)).alias("result_and_discussion"),
    )


# The places a DOI is written, in order of trust.
DOI_PATTERNS = (
    r"\bdoi:\s*(?:https?://(?:dx\.)?doi\.org/)?(10\.\d{4,}/[^\s]+)",
    r"https?://(?:dx\.)?doi\.org/(10\.\d{4,}/[^\s]+)",
    r"dx\.doi\.org/(10\.\d{4,}/[^\s]+)",
    r"\b(10\.\d{4,}/[-._;()/:a-zA-Z0-9]+)",
)


def extract_doi(text: Column) -> Column:
    """First DOI in order of pattern, without closing punctuation; null when there is none."""
    hits = [F.nullif(F.regexp_extract(text, f"(?iU){p}", 1), F.lit("")) for p in DOI_PATTERNS]
    return F.regexp_replace(F.coalesce(*hits), r"[.,;:)\]}\s]+$", "")

"""Route tasks: prompt text, provenance and statistics of each sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.text import strip
from scholion.operators.segments import judged_segments, route_segments, sample_segments
from scholion.operators.windows import RESULT_RADIUS, route_windows, row_windows, sample_sections

# The labels of the anchor block in a prompt.
ANCHOR_LABELS = (("身份标识", "sample_id"), ("名称", "name"), ("别名", "aliases"), ("聚合物分类编码", "category_code"),
                 ("聚合物分类名称", "category_name"), ("样本形态", "sample_form"))
TAGS = {"char": ("RESULT_METHOD_HINTS", "CHAR_METHODS", "CHAR_RESULTS"),
        "prop": ("RESULT_PROPERTY_HINTS", "PROPERTY_METHODS", "PROPERTY_RESULTS")}
ROLE_NAMES = {"char": {"method": "char_methods", "result": "char_results", "full": "char_results_full"},
              "prop": {"method": "prop_methods", "method_full": "prop_methods_full", "result": "prop_results",
                       "porous": "prop_results", "full": "prop_results_full"}}


def render_anchor(anchor: Column) -> Column:
    lines = []
    for label, field in ANCHOR_LABELS:
        value = F.array_join(anchor[field], ", ") if field == "aliases" else F.coalesce(anchor[field], F.lit(""))
        lines.append(F.concat(F.lit(f"{label}: "), value))
    return F.concat(F.lit("[POLYMER_ANCHOR]\n"), strip(F.concat_ws("\n", *lines)))


def _joined(label: str, items: Column) -> Column:
    return F.when(F.size(items) > 0, F.concat(F.lit(f"{label}="), F.array_join(items, ", ")))


def render_windows(tag: str, windows: Column) -> Column:
    def one(w: Column, k: Column) -> Column:
        details = F.concat_ws("; ", _joined("keywords", w["keywords"]), _joined("anchors", w["anchors"]),
                              _joined("family", w["family"]))
        header = F.concat(
            F.lit("## excerpt "), (k + 1).cast("string"), F.lit(" | block="), w["block_id"], F.lit(" | section="),
            w["section_title"], F.lit(" | lines="), w["start"].cast("string"), F.lit("-"), w["end"].cast("string"))
        return F.concat(F.when(details != "", F.concat(header, F.lit(" | "), details)).otherwise(header),
                        F.lit("\n"), w["text"])

    return F.when(F.size(windows) == 0, F.lit(f"[{tag}]")).otherwise(
        F.concat(F.lit(f"[{tag}]\n"), strip(F.array_join(F.transform(windows, one), "\n\n"))))


def render_task_text(anchor: Column, hints: Column, methods: Column, result: Column, route: str) -> Column:
    hint_tag, method_tag, result_tag = TAGS[route]
    return F.concat_ws(
        "\n\n", render_anchor(anchor),
        F.when(F.size(hints) == 0, F.lit(f"[{hint_tag}]")).otherwise(
            F.concat(F.lit(f"[{hint_tag}]\n"), F.array_join(hints, ", "))),
        render_windows(method_tag, methods), render_windows(result_tag, result))


def window_refs(windows: Column, route: str) -> Column:
    """Where each window came from."""
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES[route].items() for x in pair])
    return F.transform(windows, lambda w: F.struct(
        w["block_id"].alias("block_id"), w["chunk_index"].alias("chunk_index"),
        w["section_title"].alias("section_title"), F.element_at(names, w["kind"]).alias("route_role"),
        w["window_index"].alias("window_index"), F.array(w["start"], w["end"]).alias("line_span"),
        w["keywords"].alias("matched_keywords"), w["anchors"].alias("matched_anchors"),
        w["family"].alias("matched_family")))


TASK_COLUMNS = ["run_id", "doc_id", "sample_index", "task_id", "sample_id", "anchor", "source_refs", "text",
                "route_stats"]


def _window_tasks(sections: DataFrame, samples: DataFrame, route: str, radius: int) -> DataFrame:
    routed = route_windows(row_windows(sample_sections(sections, samples, route), route, radius), route)
    return routed.select(
        "run_id", "doc_id", "sample_index", "task_id", F.col("anchor.sample_id").alias("sample_id"), "anchor",
        window_refs(F.concat("methods", "result"), route).alias("source_refs"),
        render_task_text(F.col("anchor"), F.col("hints"), F.col("methods"), F.col("result"), route).alias("text"),
        F.struct(F.size("methods").alias("method_window_count"), F.size("result").alias("result_window_count"),
                 "used_result_fallback").alias("route_stats"),
    )


def build_char_tasks(sections: DataFrame, samples: DataFrame, radius: int = RESULT_RADIUS) -> DataFrame:
    return _window_tasks(sections, samples, "char", radius)


def build_prop_tasks(sections: DataFrame, samples: DataFrame, radius: int = RESULT_RADIUS) -> DataFrame:
    return _window_tasks(sections, samples, "prop", radius)


def render_excerpts(tag: str, excerpts: Column) -> Column:
    def one(e: Column, k: Column) -> Column:
        return strip(F.concat_ws(
            "\n", F.concat(F.lit("## excerpt "), (k + 1).cast("string")),
            F.concat(F.lit("section_title: "), e["section_title"]),
            F.concat(F.lit("segment_title: "), e["segment_title"]),
            F.concat(F.lit("line_span: "), e["start"].cast("string"), F.lit("-"), e["end"].cast("string")), e["text"]))

    return F.when(F.size(excerpts) == 0, F.lit(f"[{tag}]\n")).otherwise(
        F.concat(F.lit(f"[{tag}]\n\n"), F.array_join(F.transform(excerpts, one), "\n\n")))


def segment_refs(excerpts: Column, role: str) -> Column:
    return F.transform(excerpts, lambda e: F.struct(
        e["block_id"].alias("block_id"), e["chunk_index"].alias("chunk_index"),
        e["section_title"].alias("section_title"), e["segment_title"].alias("segment_title"),
        F.lit(role).alias("route_role"), F.array(e["start"], e["end"]).alias("line_span"),
        e["anchors"].alias("matched_anchors"), e["families"].alias("matched_families"),
        e["forms"].alias("matched_forms")))


def build_proc_tasks(sections: DataFrame, samples: DataFrame) -> DataFrame:
    routed = route_segments(judged_segments(sample_segments(sections, samples)))
    text = strip(F.concat_ws("\n\n", render_anchor(F.col("anchor")),
                             render_excerpts("PROCESS_METHODS", F.col("methods")),
                             render_excerpts("PROCESS_SUPPORT", F.col("support"))))
    return routed.select(
        "run_id", "doc_id", "sample_index", "task_id", F.col("anchor.sample_id").alias("sample_id"), "anchor",
        F.concat(segment_refs(F.col("methods"), "process_methods"),
                 segment_refs(F.col("support"), "process_support")).alias("source_refs"),
        text.alias("text"),
        F.struct(F.size("methods").alias("method_excerpt_count"), F.size("support").alias("support_excerpt_count"),
                 "used_method_fallback").alias("route_stats"),
    )

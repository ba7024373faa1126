"""Section lines: dictionary labels, segments and the features routing needs.

Everything here depends on the section alone and is computed once per section, before
samples join, so the cost does not multiply with the samples of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions import vocab
from scholion.functions.arrays import let, span
from scholion.functions.text import alternation, any_pattern, any_phrase, clean, fold, holds_required, split_lines, strip
from scholion.operators.anchors import form_groups, form_mentions, has_variant_marker, ratio_markers
from scholion.sources.routing_config import RouteConfig, route_config


def labels_of(text: Column, config: RouteConfig) -> Column:
    """Dictionary labels whose patterns occur in a text.

    A label's regex is tried only where the text holds what the label cannot do without.
    """
    everything = [p for ps in config.keywords.values() for p in ps]

    def found(low: Column) -> Column:
        return F.when(holds_required(low, everything), F.array_compact(F.array(*[
            F.when(holds_required(low, ps) & text.rlike(alternation(ps)), F.lit(label))
            for label, ps in config.keywords.items()
        ]))).otherwise(F.array().cast("array<string>"))

    return let(fold(text), found)


def section_lines(sections: DataFrame) -> DataFrame:
    """One row per section line, counted from 0."""
    keep = [c for c in ("run_id", "doc_id", "chunk_index", "block_id", "section_title") if c in sections.columns]
    return sections.select(*keep, F.posexplode(split_lines(F.col("content"))).alias("line_index", "line"))


def label_lines(lines: DataFrame, route: str) -> DataFrame:
    """Lines that carry at least one dictionary label, with their labels."""
    labelled = lines.withColumn("labels", F.array_sort(labels_of(F.col("line"), route_config(route))))
    return labelled.where(F.size("labels") > 0)


def process_signals(lines: DataFrame) -> DataFrame:
    """Lines with process action, material or support signals."""
    words = route_config("proc").keywords
    flags = {n: any_pattern(F.col("line"), words[k])
             for n, k in (("has_action", "actions"), ("has_material", "materials"), ("has_support", "support"))}
    return lines.withColumns(flags).where("has_action OR has_material OR has_support")


def is_heading_line(line: Column) -> Column:
    return line.rlike(r"(?U)^\s*#")


def segment_starts(lines: Column) -> Column:
    """Lines that open a segment: the first one and every later heading line."""
    return F.array_compact(F.transform(lines, lambda x, i: F.when((i == 0) | is_heading_line(x), i)))


def heading_segments(sections: DataFrame) -> DataFrame:
    """(start, end) line ranges between heading lines of each section."""
    ranges = let(split_lines(F.col("content")), lambda ls: let(segment_starts(ls), lambda ss: F.transform(
        ss, lambda s, k: F.struct(s.alias("start"), (F.coalesce(F.get(ss, k + 1), F.size(ls)) - 1).alias("end")))))
    return sections.select("run_id", "doc_id", "chunk_index", F.posexplode(ranges).alias("segment", "r")).select(
        "run_id", "doc_id", "chunk_index", "segment", "r.start", "r.end")


def _marked_lines(lines: Column, config: RouteConfig) -> Column:
    """Labelled lines with labels, segment bounds, forms, ratios and signals."""
    def features(x: Column, i: Column, labels: Column, starts: Column) -> Column:
        return F.struct(
            i.alias("i"), x.alias("line"), labels.alias("labels"),
            F.array_max(F.filter(starts, lambda s: s <= i)).alias("seg_start"),
            (F.coalesce(F.array_min(F.filter(starts, lambda s: s > i)), F.size(lines)) - 1).alias("seg_end"),
            form_mentions(x, config.route).alias("forms"),
            ratio_markers(x).alias("ratios"),
            (x.rlike(vocab.CAPTION) | is_heading_line(x)).alias("is_caption"),
            any_pattern(x, config.exclude).alias("excluded"),
            any_pattern(x, config.comparative).alias("comparative"),
            (has_variant_marker(x, "prop") if config.route == "prop" else F.lit(False)).alias("variant"),
        )

    return let(segment_starts(lines), lambda starts: F.filter(
        F.transform(lines, lambda x, i: let(labels_of(x, config), lambda labels: F.when(
            F.size(labels) > 0, features(x, i, labels, starts)))),
        lambda m: m.isNotNull()))


def with_line_features(sections: DataFrame, route: str) -> DataFrame:
    """Add ``lines`` (text), ``marked`` (labelled lines) and ``title_labels``."""
    config = route_config(route)
    return (
        sections.withColumn("lines", split_lines(F.col("content")))
        .withColumn("marked", _marked_lines(F.col("lines"), config))
        .withColumn("title_labels", F.array_sort(labels_of(F.col("section_title"), config)))
    )


# --- process segments

def _segment_entries(lines: Column) -> Column:
    """Lines that open a process segment, with the segment title."""
    def entry(x: Column, i: Column) -> Column:
        bare = strip(x)
        pseudo = (bare != "") & ~bare.rlike(vocab.IMAGE_LINE) & ~bare.rlike(vocab.CAPTION) & bare.rlike(
            vocab.SEGMENT_PSEUDO)
        return (
            F.when(x.rlike(vocab.SEGMENT_HEADING),
                   F.struct(i.alias("i"), clean(F.regexp_extract(x, vocab.SEGMENT_HEADING, 1)).alias("title")))
            .when(pseudo, F.struct(i.alias("i"), clean(F.rtrim(x, F.lit("."))).alias("title")))
            .when(x.rlike(vocab.SEGMENT_INLINE),
                  F.struct(i.alias("i"), clean(F.regexp_extract(x, vocab.SEGMENT_INLINE, 1)).alias("title")))
        )

    return F.array_compact(F.transform(lines, entry))


def segments_of(lines: Column, parent_title: Column) -> Column:
    """Process segments; lines before the first entry are dropped when there is any entry."""
    def cut(es: Column) -> Column:
        return F.transform(es, lambda e, k: let(
            F.coalesce(F.get(es, k + 1)["i"], F.size(lines)),
            lambda stop: F.struct(
                F.coalesce(e["title"], parent_title).alias("title"), e["i"].alias("start"), stop.alias("stop"),
                strip(F.array_join(span(lines, e["i"], stop - 1), "\n")).alias("text"))))

    whole = F.array(F.struct(F.lit(0).alias("i"), parent_title.alias("title")))
    return let(_segment_entries(lines), lambda es: F.when(F.size(es) > 0, cut(es)).otherwise(cut(whole)))


def pseudo_heading_segments(sections: DataFrame) -> DataFrame:
    """Process segments as rows."""
    segments = let(split_lines(F.col("content")), lambda ls: segments_of(ls, F.col("section_title")))
    return sections.select("run_id", "doc_id", "chunk_index", F.posexplode(segments).alias("segment", "s")).select(
        "run_id", "doc_id", "chunk_index", "segment", F.col("s.title").alias("segment_title"),
        "s.start", "s.stop", "s.text")


def segment_features(segments: Column) -> Column:
    """Process signals and forms of each segment."""
    config = route_config("proc")
    words, patterns, phrases = config.keywords, config.segment_patterns, config.segment_phrases

    def title_test(title: Column, kind: str) -> Column:
        return any_phrase(F.lower(title), phrases[kind]) | any_pattern(title, patterns[kind])

    def features(s: Column) -> Column:
        title, text = s["title"], s["text"]
        title_forms = form_groups(form_mentions(title, "proc"))
        process_title = title_test(title, "include")
        return F.struct(
            title.alias("title"), s["start"].alias("start"), s["stop"].alias("stop"), text.alias("text"),
            F.when(F.size(title_forms) > 0, title_forms).otherwise(
                form_groups(form_mentions(F.concat_ws(" ", title, text), "proc"))).alias("forms"),
            process_title.alias("process_title"),
            (~process_title & title_test(title, "exclude")).alias("excluded"),
            any_pattern(text, words["actions"]).alias("action"),
            (any_pattern(title, words["materials"]) | any_pattern(text, words["materials"])).alias("material"),
            any_pattern(text, words["support"]).alias("support"),
            has_variant_marker(text, "proc").alias("variant"),
        )

    return F.filter(F.transform(segments, features), lambda s: s["text"] != "")


def with_segment_features(sections: DataFrame) -> DataFrame:
    """Add ``segments`` to method, support and opening sections of the process route."""
    segments = let(split_lines(F.col("content")), lambda ls: segments_of(ls, F.col("section_title")))
    return sections.withColumn("segments", segment_features(segments))

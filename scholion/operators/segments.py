"""Process route: whole segments of method and support sections that concern a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.arrays import as_made, let, overlaps
from scholion.operators.anchors import (
    anchor_of, preferred, strong_hit, term_hits, with_anchor_features,
)
from scholion.operators.context import classify_sections
from scholion.operators.lines import with_segment_features

SAMPLE_KEYS = ["run_id", "doc_id", "sample_index", "task_id"]
ROLES = ("method", "support", "method_support", "front")


def sample_segments(sections: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples next to the segments of the sections that can hold process text.

    Segment features are ready before the join; a sample without such sections stays.
    """
    ready = with_segment_features(classify_sections(sections, "proc").where(F.col("role").isin(*ROLES)))
    right = ready.select("run_id", "doc_id", "chunk_index", "block_id", "section_title", "line_span", "role", "segments")
    left = with_anchor_features(samples, "proc").select(*SAMPLE_KEYS, "anchor", "a")
    return left.join(right, ["run_id", "doc_id"], "left")


def judged_segments(pairs: DataFrame) -> DataFrame:
    """Add ``candidates``: segments with the uses they qualify for.

    Uses are ``method``, ``material`` (kept back for samples without any method
    segment), ``support`` and ``weak`` (kept back for samples without any support).
    """
    anchor = anchor_of(F.col("a"), "proc")
    allowed = F.array_union(anchor.groups, preferred(anchor.groups, "proc"))
    role = F.col("role")
    first = F.col("line_span")[0]

    def judge(s: Column) -> Column:
        text, forms = s["text"], s["forms"]
        return let(F.struct(
            term_hits(text, anchor.terms).alias("anchors"), term_hits(text, anchor.family).alias("families"),
        ), lambda h: let(F.struct(
            ((F.size(h["anchors"]) > 0) & strong_hit(text, anchor.terms, "proc", anchor.is_variant)).alias("strong"),
            ((F.size(h["families"]) > 0) & ~anchor.is_variant & s["variant"]).alias("variant"),
            overlaps(forms, allowed).alias("upstream"),
            (F.array_contains(forms, "SupportedNode")
             & ((F.size(h["families"]) > 0) | ((F.size(h["anchors"]) > 0)
                & strong_hit(text, anchor.terms, "proc", anchor.is_variant)))).alias("node"),
            ((F.size(forms) == 0) & (F.size(anchor.groups) > 0)).alias("formless"),
            (F.size(h["families"]) > 0).alias("family"), (F.size(h["anchors"]) > 0).alias("hit"),
        ), lambda t: F.struct(
            F.col("chunk_index").alias("chunk_index"),
            (first + s["start"]).alias("start"),
            (first + F.greatest(s["stop"] - 1, s["start"])).alias("end"),
            F.col("block_id").alias("block_id"), F.col("section_title").alias("section_title"),
            s["title"].alias("segment_title"),
            h["anchors"].alias("anchors"), h["families"].alias("families"), F.array_sort(forms).alias("forms"),
            text.alias("text"),
            F.array_compact(F.array(
                F.when(role.isin("method", "method_support") & ~s["excluded"]
                       & (s["process_title"] | s["action"] | s["material"] | t["hit"])
                       & (t["strong"] | (~t["variant"] & t["upstream"]
                                         & (t["family"] | s["process_title"] | s["action"]))), F.lit("method")),
                F.when(role.isin("method", "method_support") & ~s["excluded"] & s["material"], F.lit("material")),
                F.when(role.isin("support", "method_support") & (~s["excluded"] | t["node"])
                       & (s["process_title"] | s["action"] | s["support"] | t["node"])
                       & (t["strong"] | (~t["variant"] & t["family"] & (t["upstream"] | t["formless"]))),
                       F.lit("support")),
                F.when((role == "front") & (t["hit"] | t["family"])
                       & (s["action"] | s["support"] | t["upstream"] | t["formless"])
                       & (t["strong"] | ~t["variant"]), F.lit("weak")),
            )).alias("uses"),
        )))

    judged = F.filter(F.transform("segments", judge), lambda c: F.size(c["uses"]) > 0)
    # material segments only matter where the section has no method segment of its own
    def held_back(cs: Column) -> Column:
        has_method = F.exists(cs, lambda c: F.array_contains(c["uses"], "method"))
        slim = F.transform(cs, lambda c: c.withField("uses", F.when(
            has_method, F.array_remove(c["uses"], "material")).otherwise(c["uses"])))
        return F.filter(slim, lambda c: F.size(c["uses"]) > 0)

    return pairs.withColumn("candidates", let(judged, held_back))


def segment_rows(judged: DataFrame) -> DataFrame:
    """Candidates as rows, one per use."""
    return judged.select(*SAMPLE_KEYS, F.explode(as_made("candidates")).alias("c")).select(
        *SAMPLE_KEYS, F.explode("c.uses").alias("use"), "c.*").drop("uses")


def dedupe_excerpts(rows: DataFrame) -> DataFrame:
    """First excerpt per sample, use, block, segment title and span."""
    keys = [c for c in SAMPLE_KEYS if c in rows.columns] + ["use", "block_id", "segment_title", "start", "end"]
    rest = [c for c in rows.columns if c not in keys and c != "chunk_index"]
    firsts = rows.groupBy(*keys).agg(F.min(F.struct("chunk_index", *rest)).alias("r"))
    return firsts.select(*keys, "r.*")


def route_segments(judged: DataFrame) -> DataFrame:
    """Per sample: method and support excerpts, falling back where none qualified."""
    grouped = judged.groupBy(*SAMPLE_KEYS).agg(
        F.first("anchor").alias("anchor"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("candidates")))).alias("all"))

    def used(name: str) -> Column:
        return F.transform(F.filter("all", lambda c: F.array_contains(c["uses"], name)),
                           lambda c: c.dropFields("uses"))

    def first_of(a: str, b: str) -> Column:
        return let(used(a), lambda xs: F.when(F.size(xs) > 0, xs).otherwise(used(b)))

    return grouped.select(
        *SAMPLE_KEYS, "anchor",
        first_of("method", "material").alias("methods"),
        first_of("support", "weak").alias("support"),
        ((F.size(used("method")) == 0) & (F.size(used("material")) > 0)).alias("used_method_fallback"),
    )

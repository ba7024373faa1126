"""Characterization and property routes: context windows around labelled lines.

One row is one sample with one section of its document. Seeds, ranges and windows of a
row come from array functions on that row; only finished windows move on to the
per-sample step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.arrays import as_made, let, overlaps, sorted_set, span
from scholion.functions.text import any_pattern, strip
from scholion.operators.anchors import (
    Anchor, anchor_of, any_term, form_mentions, has_variant_marker, preferred, ratio_markers, strong_hit, term_hits,
    with_anchor_features,
)
from scholion.operators.context import classify_sections
from scholion.operators.lines import labels_of, with_line_features
from scholion.sources.routing_config import route_config

RESULT_RADIUS = 6
METHOD_RADIUS = 4
TIGHT_RADIUS = 1
POROUS_FALLBACK_RADIUS = 2
SAMPLE_KEYS = ["run_id", "doc_id", "sample_index", "task_id"]
SECTION_FIELDS = ["chunk_index", "block_id", "section_title", "line_span", "role"]


def sample_sections(sections: DataFrame, samples: DataFrame, route: str) -> DataFrame:
    """Samples next to the method and result sections of their document.

    Both sides are narrowed before the join, and section features are ready by then.
    Samples of documents without such sections stay, with empty section columns.
    """
    marked = with_line_features(
        classify_sections(sections, route).where(F.col("role").isin("method", "result")), route)
    columns = SECTION_FIELDS + ["lines", "marked", "title_labels"]
    if route == "prop":
        columns.append("property_title")
    right = marked.select("run_id", "doc_id", *columns)
    left = with_anchor_features(samples, route).select(*SAMPLE_KEYS, "anchor", "a")
    return left.join(right, ["run_id", "doc_id"], "left")


def _prop_labels(text: Column) -> Column:
    return labels_of(text, route_config("prop"))


def _fluid_family(anchor: Anchor, labels: Column) -> Column:
    """A fluid anchor next to a flow property; the family hit is tested by the caller."""
    fluid_labels = F.array(*[F.lit(x) for x in route_config("prop").preferences["PrecursorFluid"]])
    return anchor.is_fluid & overlaps(labels, fluid_labels)


def _line_flags(m: Column, anchor: Anchor) -> Column:
    """Sample-dependent facts of one labelled line."""
    conflict = anchor.form_conflict(m["forms"])
    ratio = anchor.ratio_conflict(m["ratios"])
    hit = any_term(m["line"], anchor.terms)
    if anchor.route == "char":
        family = ~ratio & anchor.shares_form(m["forms"]) & any_term(m["line"], anchor.family)
        morph = F.array_contains(m["labels"], "Morphology") & ~anchor.is_fluid & anchor.shares_form(m["forms"])
        strong, variant = F.lit(False), F.lit(False)
    else:
        any_family = any_term(m["line"], anchor.family)
        variant = ~anchor.is_variant & m["variant"] & any_family
        fluid = _fluid_family(anchor, m["labels"])
        family = any_family & ~variant & (~ratio | fluid) & (anchor.shares_form(m["forms"]) | fluid)
        strong = hit & strong_hit(m["line"], anchor.terms, "prop", anchor.is_variant)
        morph = F.lit(False)
    return F.struct(
        m["i"].alias("i"), m["labels"].alias("labels"), m["seg_start"].alias("seg_start"),
        m["seg_end"].alias("seg_end"), m["is_caption"].alias("is_caption"), m["excluded"].alias("excluded"),
        m["comparative"].alias("comparative"), hit.alias("hit"), strong.alias("strong"), variant.alias("variant"),
        conflict.alias("conflict"), family.alias("family"), morph.alias("morph"),
    )


def line_hints(f: Column, route: str) -> Column:
    """Labels a line vouches for."""
    none = F.array().cast("array<string>")
    if route == "prop":
        return F.when(f["hit"] | f["family"], f["labels"]).otherwise(none)
    return (
        F.when(f["hit"] | f["family"] | (f["is_caption"] & f["morph"]), f["labels"])
        .when(f["morph"], F.array(F.lit("Morphology"))).otherwise(none)
    )


def _nearby_support(f: Column, lines: Column, anchor: Anchor, radius: int) -> Column:
    """Anchor or family support within the radius around a caption, inside its segment."""
    text = F.array_join(span(lines, F.greatest(f["seg_start"], f["i"] - radius),
                             F.least(f["seg_end"], f["i"] + radius)), "\n")
    return let(text, lambda t: let(form_mentions(t, anchor.route), lambda forms: (
        ~anchor.form_conflict(forms)
        & (any_term(t, anchor.terms)
           | (anchor.shares_form(forms) & ~anchor.ratio_conflict(ratio_markers(t)) & any_term(t, anchor.family)))
    )))


def is_focused(f: Column, lines: Column, anchor: Anchor, radius: int) -> Column:
    """Whether a labelled line concerns the sample itself."""
    if anchor.route == "prop":
        return F.when(f["hit"], ~(~f["strong"] & f["variant"]) & ~f["conflict"]).otherwise(f["family"])
    return F.when(f["hit"], ~f["conflict"]).otherwise(
        f["family"] | f["morph"] | (f["is_caption"] & _nearby_support(f, lines, anchor, radius)))


def pick_seeds(flags: Column, lines: Column, anchor: Anchor, radius: int) -> Column:
    """Focused lines, or all labelled lines when none is focused."""
    def narrow(focused: Column) -> Column:
        return F.when(F.size(focused) > 0, focused).otherwise(flags)

    seeds = let(F.filter(flags, lambda f: is_focused(f, lines, anchor, radius)), narrow)
    if anchor.route == "char":
        return seeds
    return let(seeds, lambda ss: let(F.filter(ss, lambda f: f["strong"]), lambda strong: F.when(
        anchor.is_porous & ~anchor.is_variant & (F.size(strong) > 0), strong).otherwise(ss)))


def context_ranges(seeds: Column, anchor: Anchor | None, radius: int) -> Column:
    """Line range around each seed, clipped to its segment."""
    def one(f: Column) -> Column:
        r = F.lit(radius)
        alone = F.lit(False)
        if anchor is not None and anchor.route == "prop":
            plain = f["strong"] & ~anchor.is_variant
            r = F.when(plain | _fluid_family(anchor, f["labels"]), min(radius, TIGHT_RADIUS)).otherwise(radius)
            # seeds of a plain porous sample are all strong or none is
            alone = plain & anchor.is_porous
        return F.struct(
            F.greatest(f["seg_start"], f["i"] - r).alias("s"), F.least(f["seg_end"], f["i"] + r).alias("e"),
            f["seg_start"].alias("segment"), alone.alias("alone"),
        )

    return F.array_sort(F.transform(seeds, one))


def merge_ranges(ranges: Column) -> Column:
    """Join ranges of a segment that overlap or touch."""
    kind = "array<struct<s:int,e:int,segment:int,alone:boolean>>"

    def step(done: Column, r: Column) -> Column:
        last = F.element_at(done, -1)
        joins = ~r["alone"] & (r["segment"] == last["segment"]) & (r["s"] <= last["e"] + 1)
        wider = last.withField("e", F.greatest(last["e"], r["e"]))
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(r)))

    def first_or_step(done: Column, r: Column) -> Column:
        return F.when(F.size(done) == 0, F.array(r)).otherwise(step(done, r))

    return F.aggregate(ranges.cast(kind), F.array().cast(kind), first_or_step)


def numbered(lines: Column, s: Column, e: Column, first: Column) -> Column:
    """Lines s..e with their absolute numbers, as one text."""
    return strip(F.array_join(F.transform(
        span(lines, s, e), lambda x, k: F.concat((first + s + k).cast("string"), F.lit(": "), x)), "\n"))


def window_struct(ranges: Column, flags: Column, row: dict[str, Column], anchor: Anchor, kind: str) -> Column:
    """Windows of one section with everything the per-sample step decides on."""
    route, config = anchor.route, route_config(anchor.route)
    lines, first = row["lines"], row["line_span"][0]
    results = kind != "method"

    def excluded(inside: Column, keywords: Column, forms: Column, text: Column) -> Column:
        derived = anchor.derived_other_form(forms, text)
        signal = any_pattern(text, config.exclude)
        if route == "prop":
            return derived | signal
        side = F.array_intersect(keywords, F.array(F.lit("Morphology"), F.lit("BET")))
        direct = F.exists(inside, lambda f: (
            overlaps(f["labels"], side) & ~(f["excluded"] & f["comparative"])
            & (f["hit"] | f["family"] | f["morph"]) & (f["is_caption"] | ~f["excluded"])))
        comparative = (F.size(side) > 0) & any_pattern(text, config.comparative) & ~direct
        return derived | (signal & (comparative | ~F.array_contains(keywords, "Morphology") | anchor.is_fluid))

    def general(keywords: Column, forms: Column, family: Column, text: Column, conflict: Column) -> Column:
        """Window without anchor hit that still speaks of the same product node."""
        same_node = (F.size(family) > 0) & anchor.shares_form(forms)
        if route == "char":
            morph = F.array_contains(keywords, "Morphology") & ~anchor.is_fluid & anchor.shares_form(forms)
            return ~conflict & (same_node | morph)
        fluid = (F.size(family) > 0) & _fluid_family(anchor, _prop_labels(text))
        return (~conflict | fluid) & (same_node | fluid)

    def one(r: Column, k: Column) -> Column:
        raw = F.array_join(span(lines, r["s"], r["e"]), "\n")
        inside = F.filter(flags, lambda f: (r["s"] <= f["i"]) & (f["i"] <= r["e"]))
        return let(F.struct(
            inside.alias("inside"),
            numbered(lines, r["s"], r["e"], first).alias("text"),
            raw.alias("raw"),
        ), lambda w: let(F.struct(
            sorted_set(F.transform(w["inside"], lambda f: f["labels"])).alias("keywords"),
            F.array_sort(F.array_distinct(term_hits(w["raw"], anchor.terms))).alias("anchors"),
            term_hits(w["text"], anchor.family).alias("family"),
            form_mentions(w["text"], route).alias("forms"),
            anchor.ratio_conflict(ratio_markers(w["text"])).alias("conflict"),
        ), lambda v: let(
            (F.lit(False) if route == "char" or not results else
             ~anchor.is_variant & (F.size(v["family"]) > 0) & has_variant_marker(w["text"], "prop")),
            lambda variant: F.struct(
                row["chunk_index"].alias("chunk_index"),
                (first + r["s"]).alias("start"),
                (k + 1).alias("window_index"),
                (first + r["e"]).alias("end"),
                row["block_id"].alias("block_id"),
                row["section_title"].alias("section_title"),
                F.lit(kind).alias("kind"),
                v["keywords"].alias("keywords"), v["anchors"].alias("anchors"), v["family"].alias("family"),
                v["conflict"].alias("conflict"), w["text"].alias("text"),
                sorted_set(F.transform(w["inside"], lambda f: line_hints(f, route))).alias("hints"),
                (excluded(w["inside"], v["keywords"], v["forms"], w["text"]) if results else F.lit(False))
                .alias("excluded"),
                (variant & ~((F.size(v["anchors"]) > 0) & strong_hit(w["text"], F.filter(
                    anchor.terms, lambda t: F.array_contains(v["anchors"], t["label"])), "prop", anchor.is_variant))
                 if route == "prop" and results else F.lit(False)).alias("dropped"),
                ((general(v["keywords"], v["forms"], v["family"], w["text"], v["conflict"]) & ~variant)
                 if results else F.lit(False)).alias("general"),
            ))))

    return F.transform(ranges, one)


def full_section(row: dict[str, Column], flags: Column, anchor: Anchor, kind: str) -> Column:
    """A whole section as one window, for the fallbacks."""
    lines = row["lines"]
    return F.struct(
        row["chunk_index"].alias("chunk_index"), row["line_span"][0].alias("start"), F.lit(0).alias("window_index"),
        row["line_span"][1].alias("end"), row["block_id"].alias("block_id"),
        row["section_title"].alias("section_title"), F.lit(kind).alias("kind"),
        sorted_set(F.concat(F.array(row["title_labels"]), F.transform(flags, lambda f: f["labels"]))).alias("keywords"),
        F.array_sort(F.array_distinct(term_hits(F.array_join(lines, "\n"), anchor.terms))).alias("anchors"),
        F.array().cast("array<string>").alias("family"), F.lit(False).alias("conflict"),
        numbered(lines, F.lit(0), F.size(lines) - 1, row["line_span"][0]).alias("text"),
        sorted_set(F.transform(flags, lambda f: line_hints(f, anchor.route))).alias("hints"),
        F.lit(False).alias("excluded"), F.lit(False).alias("dropped"), F.lit(False).alias("general"),
    )


def section_hints(row: dict[str, Column], anchor: Anchor) -> Column:
    """Title labels of a result section that concerns the sample."""
    text = F.array_join(row["lines"], "\n")
    labels = row["title_labels"]
    test = let(text, lambda t: let(form_mentions(t, anchor.route), lambda forms: (
        (any_term(t, anchor.terms) | (anchor.shares_form(forms) & any_term(t, anchor.family))
         | (F.array_contains(labels, "Morphology") & ~anchor.is_fluid & anchor.shares_form(forms)))
        & ~anchor.derived_other_form(forms, t))))
    return F.when((F.size(labels) > 0) & test, labels).otherwise(F.array().cast("array<string>"))


def row_windows(pairs: DataFrame, route: str, radius: int = RESULT_RADIUS) -> DataFrame:
    """Add to each sample-section row its windows, fallback candidates and title hints."""
    anchor = anchor_of(F.col("a"), route)
    row = {n: F.col(n) for n in SECTION_FIELDS + ["lines", "title_labels"]}
    is_result, is_method = F.col("role") == "result", F.col("role") == "method"

    def windows(flags: Column, r: int, kind: str) -> Column:
        return let(pick_seeds(flags, row["lines"], anchor, r), lambda seeds: let(
            merge_ranges(context_ranges(seeds, anchor, r)),
            lambda ranges: window_struct(ranges, flags, row, anchor, kind)))

    flagged = pairs.withColumn("flags", F.transform("marked", lambda m: _line_flags(m, anchor)))
    flags = F.col("flags")
    method = let(merge_ranges(context_ranges(flags, None, METHOD_RADIUS)),
                 lambda ranges: window_struct(ranges, flags, row, anchor, "method"))
    made = flagged.withColumn(
        "windows", F.when(is_result, windows(flags, radius, "result")).when(is_method, method))
    result_windows = F.col("windows")
    kept = F.filter(result_windows, lambda w: ~w["dropped"])
    none = F.slice(result_windows, 1, 0)
    full_ok = is_result & (F.size(kept) == 0)
    fallback = F.when(full_ok & (F.col("property_title") if route == "prop" else F.lit(True)),
                      F.array(full_section(row, flags, anchor, "full"))).otherwise(none)
    extra = [fallback]
    if route == "prop":
        porous = F.when(
            is_result & anchor.is_porous & ~F.exists(kept, lambda w: ~w["excluded"]),
            F.filter(windows(flags, min(radius, POROUS_FALLBACK_RADIUS), "porous"),
                     lambda w: ~w["dropped"] & ~w["excluded"])).otherwise(none)
        titled = F.when(is_method & (F.size("title_labels") > 0),
                        F.array(full_section(row, flags, anchor, "method_full"))).otherwise(none)
        extra += [porous, titled]
    return made.withColumn("candidates", F.concat(kept, *extra)).withColumn(
        "title_hints", F.when(is_result, section_hints(row, anchor)) if route == "char"
        else F.lit(None).cast("array<string>"))


def select_seeds(pairs: DataFrame, route: str, radius: int = RESULT_RADIUS) -> DataFrame:
    """Seed lines of result sections as rows."""
    anchor = anchor_of(F.col("a"), route)
    seeds = let(F.transform("marked", lambda m: _line_flags(m, anchor)),
                lambda flags: pick_seeds(flags, F.col("lines"), anchor, radius))
    return pairs.where("role = 'result'").select(
        *SAMPLE_KEYS, "chunk_index", F.explode(seeds).alias("s")).select(
        *SAMPLE_KEYS, "chunk_index", F.col("s.i").alias("line_index"), "s.labels", "s.hit", "s.family")


def seed_ranges(pairs: DataFrame, route: str, radius: int = RESULT_RADIUS) -> DataFrame:
    """Merged line ranges of result sections as rows."""
    anchor = anchor_of(F.col("a"), route)
    ranges = let(F.transform("marked", lambda m: _line_flags(m, anchor)), lambda flags: merge_ranges(
        context_ranges(pick_seeds(flags, F.col("lines"), anchor, radius), anchor, radius)))
    return pairs.where("role = 'result'").select(
        *SAMPLE_KEYS, "chunk_index", F.posexplode(ranges).alias("k", "r")).select(
        *SAMPLE_KEYS, "chunk_index", (F.col("k") + 1).alias("window_index"),
        F.col("r.s").alias("start"), F.col("r.e").alias("end"))


def build_windows(rows: DataFrame) -> DataFrame:
    """All windows of ``row_windows`` as rows, excluded ones included."""
    return rows.select(*SAMPLE_KEYS, F.explode(as_made("windows")).alias("w")).select(*SAMPLE_KEYS, "w.*")


def route_windows(rows: DataFrame, route: str) -> DataFrame:
    """Per sample: the result and method windows that go into its task, and the hints.

    Only finished windows move; a group holds what one task text is made of.
    """
    order = F.array_sort(F.flatten(F.collect_list("candidates")))
    grouped = rows.groupBy(*SAMPLE_KEYS).agg(
        F.first("anchor").alias("anchor"), F.first("a.groups").alias("groups"), order.alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("title_hints")))).alias("title_hints"),
    )
    raw = F.filter("all", lambda w: w["kind"] == "result")
    ranked = let(F.filter(raw, lambda w: ~w["excluded"]), lambda ws: F.when(
        F.exists(ws, lambda w: F.size(w["anchors"]) > 0),
        F.filter(ws, lambda w: (F.size(w["anchors"]) > 0) | w["general"])).otherwise(ws))
    full = F.transform(F.filter("all", lambda w: w["kind"] == "full"),
                       lambda w, k: w.withField("window_index", k + 1))
    staged = grouped.withColumn("raw_count", F.size(raw)).withColumn("ranked", ranked)
    if route == "prop":
        porous_labels = F.array(*[F.lit(x) for x in route_config("prop").preferences["PorousBody"]])
        porous = narrow_labels(F.filter("all", lambda w: w["kind"] == "porous"), porous_labels)
        result = (
            F.when(F.size("ranked") > 0, F.col("ranked"))
            .when((F.col("raw_count") > 0) & F.array_contains("groups", "PorousBody"), porous)
            .when(F.col("raw_count") == 0, full).otherwise(F.col("ranked"))
        )
    else:
        result = F.when((F.size("ranked") == 0) & (F.col("raw_count") == 0), full).otherwise(F.col("ranked"))
    staged = staged.withColumn("result", result).withColumn(
        "used_result_fallback", (F.size("ranked") == 0) & (F.size("result") > 0))
    hints = sorted_set(F.transform("result", lambda w: w["hints"]))
    if route == "char":
        staged = staged.withColumn("hints", F.array_sort(F.array_union(hints, F.col("title_hints"))))
    else:
        staged = staged.withColumn("hints", hints).withColumn("hints", preferred_hints(F.col("hints"), F.col("groups")))
        staged = staged.withColumn("result", F.when(
            F.size("hints") > 0, narrow_labels(F.col("result"), F.col("hints"))).otherwise(F.col("result")))
    return staged.withColumn("methods", method_excerpts(F.col("all"), F.col("hints"), route)).select(
        *SAMPLE_KEYS, "anchor", "hints", "methods", "result", "used_result_fallback", "raw_count",
        (F.size("ranked") > 0).alias("had_ranked"))


def preferred_hints(hints: Column, groups: Column) -> Column:
    """Hints the anchor's forms prefer; all hints when the forms prefer none of them."""
    return let(F.array_intersect(hints, preferred(groups, "prop")),
               lambda kept: F.when(F.size(kept) > 0, kept).otherwise(hints))


def narrow_labels(windows: Column, labels: Column) -> Column:
    """Windows cut down to the given labels; those without any are left out."""
    cut = F.transform(windows, lambda w: w.withField("keywords", F.array_intersect(w["keywords"], labels)))
    return F.filter(cut, lambda w: F.size(w["keywords"]) > 0)


def method_excerpts(windows: Column, hints: Column, route: str) -> Column:
    """Method windows that speak of the hinted labels."""
    kept = narrow_labels(F.filter(windows, lambda w: w["kind"] == "method"), hints)
    if route == "char":
        return kept

    def title_labels(w: Column) -> Column:
        return _prop_labels(w["section_title"])

    agreeing = F.filter(kept, lambda w: let(title_labels(w), lambda ls: (F.size(ls) == 0) | overlaps(ls, hints)))
    whole = F.transform(
        F.filter(windows, lambda w: (w["kind"] == "method_full") & overlaps(title_labels(w), hints)),
        lambda w, k: w.withField("window_index", k + 1))
    return let(agreeing, lambda ws: F.when(F.size(ws) > 0, ws).otherwise(whole))

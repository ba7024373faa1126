"""Sample anchors: the terms that identify a sample and tests of text against them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from scholion.functions import vocab
from scholion.functions.arrays import dedup_ignore_case, let, overlaps
from scholion.functions.text import any_pattern, clean
from scholion.sources.routing_config import route_config

ROUTE_STAGE = {"char": "characterization", "prop": "property", "proc": "process"}
SHORT_CODE = r"^[A-Z0-9/+-]+\z"
SHORT_BASE_CODE = r"^[A-Z0-9+-]+\z"
CODE_TOKEN = r"(?U)\b[A-Z][A-Z0-9/+-]{1,}\b"


def explode_samples(main: DataFrame, route: str) -> DataFrame:
    """One row per sample of (run_id, doc_id, file_name, samples) documents, counted from 1."""
    missing = F.raise_error(F.concat(F.lit("document without samples array: "), F.col("doc_id")))
    # a filter stays where a column that nobody reads would be pruned
    one = main.where(F.when(F.col("samples").isNull(), missing.cast("boolean")).otherwise(True)).select(
        "run_id", "doc_id", *[c for c in ("file_name",) if c in main.columns], F.posexplode("samples").alias("i", "s"))
    aliases = F.col("s.aliases") if "aliases" in main.schema["samples"].dataType.elementType.names else F.lit(None)
    return anchor_rows(one.select(
        "run_id", "doc_id", *[c for c in ("file_name",) if c in main.columns],
        (F.col("i") + 1).alias("sample_index"),
        F.col("s.sample_id").alias("sample_id"), F.col("s.name").alias("name"),
        aliases.cast("array<string>").alias("aliases"),
        F.col("s.category_code").alias("category_code"), F.col("s.category_name").alias("category_name"),
        F.col("s.sample_form").alias("sample_form"),
    ), route)


def anchor_rows(samples: DataFrame, route: str) -> DataFrame:
    """Normalized anchor fields and the task id of each sample row."""
    aliases = F.col("aliases") if "aliases" in samples.columns else F.lit(None).cast("array<string>")
    sample_id = clean(F.col("sample_id"))
    if route == "proc":
        sample_id = F.coalesce(sample_id, F.raise_error(
            F.concat(F.lit("sample without id in document "), F.col("doc_id"))).cast("string"))
    return samples.select(
        "run_id", "doc_id", *[c for c in ("file_name",) if c in samples.columns],
        F.col("sample_index").cast("int").alias("sample_index"),
        F.concat_ws("__", "run_id", "doc_id", F.format_string("%03d", F.col("sample_index").cast("int")),
                    F.lit(ROUTE_STAGE[route])).alias("task_id"),
        F.struct(
            sample_id.alias("sample_id"),
            clean(F.col("name")).alias("name"),
            dedup_ignore_case(F.array_compact(F.transform(
                F.coalesce(aliases, F.array().cast("array<string>")), clean))).alias("aliases"),
            clean(F.col("category_code")).alias("category_code"),
            clean(F.col("category_name")).alias("category_name"),
            clean(F.col("sample_form")).alias("sample_form"),
        ).alias("anchor"),
    )


def require_sections(samples: DataFrame, sections: DataFrame) -> DataFrame:
    """Samples with a flag for documents that have no section rows; they raise when read."""
    present = sections.select("run_id", "doc_id").distinct().withColumn("_has", F.lit(True))
    absent = F.raise_error(F.concat(F.lit("no sections for document "), F.col("doc_id"))).cast("boolean")
    return samples.join(present, ["run_id", "doc_id"], "left").where(F.when(F.col("_has"), True).otherwise(absent)).drop("_has")


# --- terms

def _is_code(label: Column) -> Column:
    return (F.length(label) <= 6) & label.rlike(SHORT_CODE)


def _term(label: Column, route: str) -> Column:
    """A short code matches as written between code boundaries; other terms as literals."""
    plural = "" if route == "char" else "(?:s)?"
    escaped = F.regexp_replace(label, r"(\p{Punct})", r"\\$1")
    code = F.concat(F.lit("(?<![A-Za-z0-9/+-])"), escaped, F.lit(f"{plural}(?![A-Za-z0-9/+-])"))
    return let(_is_code(label), lambda is_code: F.struct(
        label.alias("label"),
        is_code.alias("is_code"),
        F.when(is_code, code).otherwise(F.concat(F.lit("(?iu)"), escaped)).alias("pattern"),
        F.lower(label).alias("needle"),
    ))


def _code_variants(code: Column) -> list[Column]:
    has_slash = code.contains("/")
    return [F.when(has_slash, F.replace(code, F.lit("/"), F.lit("-"))),
            F.when(has_slash, F.replace(code, F.lit("/"), F.lit(" / ")))]


def anchor_labels(anchor: Column, route: str) -> Column:
    """Name, aliases, category code and specific category name; distinct ignoring case."""
    code, name = anchor["category_code"], anchor["category_name"]
    shown = code
    if route != "char":
        short = (F.length(code) <= 6) & code.rlike(SHORT_BASE_CODE) & anchor["name"].isNotNull()
        shown = F.when(~short, code)
    specific = F.when(~F.lower(name).isin(*vocab.GENERIC_CATEGORY_NAMES), name)
    terms = F.concat(F.array(anchor["name"]), anchor["aliases"],
                     F.array(shown, *_code_variants(code), specific))
    return dedup_ignore_case(F.array_compact(F.transform(terms, clean)))


def family_labels(anchor: Column, route: str) -> Column:
    """Category code and name, the name without ratio, and every code token in them."""
    code = anchor["category_code"]
    variants = [] if route == "proc" else _code_variants(code)
    bases = F.array(code, *variants, anchor["category_name"], F.regexp_replace(anchor["name"], vocab.RATIO, ""))
    full = F.array_compact(F.transform(bases, clean))
    return dedup_ignore_case(F.flatten(F.transform(
        full, lambda t: F.concat(F.array(t), F.regexp_extract_all(t, F.lit(CODE_TOKEN), F.lit(0))))))


def term_structs(labels: Column, route: str) -> Column:
    return F.transform(labels, lambda t: _term(t, route))


def anchor_terms(samples: DataFrame, route: str) -> DataFrame:
    """One row per anchor term of each sample."""
    return _term_rows(samples, term_structs(anchor_labels(F.col("anchor"), route), route))


def family_terms(samples: DataFrame, route: str) -> DataFrame:
    """One row per family term of each sample."""
    return _term_rows(samples, term_structs(family_labels(F.col("anchor"), route), route))


def _term_rows(samples: DataFrame, terms: Column) -> DataFrame:
    return samples.select("run_id", "doc_id", "sample_index", F.posexplode(terms).alias("ord", "t")).select(
        "run_id", "doc_id", "sample_index", "ord", "t.label", "t.is_code", "t.pattern")


def _found(text: Column, low: Column, term: Column) -> Column:
    """A term occurs in a text; the pattern of a code is only built where the code stands in the text."""
    return F.when(term["is_code"], text.contains(term["label"]) & F.rlike(text, term["pattern"])).otherwise(
        low.contains(term["needle"]))


def term_hits(text: Column, terms: Column) -> Column:
    """Labels of the terms found in a text."""
    return let(text, lambda x: let(F.lower(x), lambda low: F.transform(
        F.filter(terms, lambda t: _found(x, low, t)), lambda t: t["label"])))


def any_term(text: Column, terms: Column) -> Column:
    return let(text, lambda x: let(F.lower(x), lambda low: F.exists(terms, lambda t: _found(x, low, t))))


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def strong_hit(text: Column, terms: Column, route: str, anchor_is_variant: Column) -> Column:
    """An anchor hit that no variant tail (such as '-doped') follows."""
    tail = f"(?!(?iU:{vocab.VARIANT_TAIL[route]}))"

    def near(t: Column, low: Column) -> Column:
        """Cheap first test; only between plain letters is the lower case the form that a pattern compares."""
        plain = low.contains(t["needle"])
        return F.when(t["is_code"], text.contains(t["label"])).otherwise(
            plain | ~_is_ascii(text) | ~_is_ascii(t["label"]))

    return F.when(anchor_is_variant, any_term(text, terms)).otherwise(let(F.lower(text), lambda low: F.exists(
        terms, lambda t: near(t, low) & F.rlike(text, F.concat(t["pattern"], F.lit(tail))))))


# --- forms, ratios, variants

def form_mentions(text: Column, route: str) -> Column:
    """Forms a text names, as whole words."""
    words = {w: form for form, ws in vocab.FORM_WORDS[route].items() for w in ws}
    pattern = f"(?<![a-z])({'|'.join(words)}){vocab.FORM_PLURAL[route]}(?![a-z])"
    names = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    return F.array_distinct(F.transform(
        F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(1)),
        lambda w: F.element_at(names, w)))


def form_groups(forms: Column) -> Column:
    """Forms together with the groups they belong to."""
    groups = F.create_map(*[F.lit(x) for pair in vocab.FORM_GROUPS.items() for x in pair])
    return F.array_union(forms, F.transform(forms, lambda f: F.coalesce(F.element_at(groups, f), f)))


def preferred(groups: Column, route: str) -> Column:
    """Entries the route's preference table lists for any of the groups."""
    table = route_config(route).preferences
    pairs = [x for k, vs in table.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))]
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.flatten(F.transform(
        groups, lambda g: F.coalesce(F.element_at(F.create_map(*pairs), g), empty))))


def ratio_markers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(vocab.RATIO), F.lit(0)),
                       lambda m: F.regexp_replace(F.lower(m), r"(?U)\s+", ""))


def ratio_conflict(anchor_ratios: Column, ratios: Column) -> Column:
    """Both sides give ratios and share none."""
    return (F.size(anchor_ratios) > 0) & (F.size(ratios) > 0) & ~overlaps(anchor_ratios, ratios)


def has_variant_marker(text: Column, route: str) -> Column:
    return any_pattern(text, vocab.VARIANT_MARKERS[route])


@dataclass(frozen=True)
class Anchor:
    """Columns of one sample that the routing tests use."""

    route: str
    terms: Column
    family: Column
    forms: Column
    groups: Column
    ratios: Column
    is_variant: Column

    @property
    def is_fluid(self) -> Column:
        return overlaps(self.forms, F.array(*[F.lit(f) for f in vocab.FLUID_FORMS]))

    @property
    def is_porous(self) -> Column:
        return F.array_contains(self.groups, "PorousBody")

    def widen(self, forms: Column) -> Column:
        return forms if self.route == "char" else form_groups(forms)

    def shares_form(self, forms: Column) -> Column:
        return (F.size(self.forms) > 0) & overlaps(self.widen(forms), self.widen(self.forms))

    def form_conflict(self, forms: Column) -> Column:
        return (F.size(self.forms) > 0) & (F.size(forms) > 0) & ~overlaps(self.widen(forms), self.widen(self.forms))

    def ratio_conflict(self, ratios: Column) -> Column:
        return ratio_conflict(self.ratios, ratios)

    def derived_other_form(self, forms: Column, text: Column) -> Column:
        """A fluid anchor, while the text speaks of turning it into another form."""
        outside = F.size(F.array_except(self.widen(forms), self.widen(self.forms))) > 0
        return self.is_fluid & (F.size(forms) > 0) & outside & any_pattern(text, vocab.TRANSITIONS)


def with_anchor_features(samples: DataFrame, route: str) -> DataFrame:
    """Precompute the per-sample side of all routing tests in one struct column ``a``."""
    anchor = F.col("anchor")
    forms = form_mentions(anchor["sample_form"], route)
    joined = F.concat_ws(" ", anchor["name"], anchor["category_code"], anchor["category_name"])
    variant = has_variant_marker(joined, route) if route != "char" else F.lit(False)
    return samples.withColumn("a", F.struct(
        term_structs(anchor_labels(anchor, route), route).alias("terms"),
        term_structs(family_labels(anchor, route), route).alias("family"),
        forms.alias("forms"),
        form_groups(forms).alias("groups"),
        F.array_distinct(ratio_markers(F.coalesce(anchor["name"], F.lit("")))).alias("ratios"),
        variant.alias("is_variant"),
    ))


def anchor_of(column: Column, route: str) -> Anchor:
    return Anchor(route, *[column[n] for n in ("terms", "family", "forms", "groups", "ratios", "is_variant")])


#: Samples of a document whose terms share one automaton.
SAMPLES_AT_ONCE = 256
_CODE_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789/+-")


def fold_case(text: str) -> str:
    """The text sign by sign in the form that a comparison without regard to case uses."""
    if text.isascii():
        return text.lower()

    def one(c: str) -> str:
        upper = c.upper() if len(c.upper()) == 1 else c
        return upper.lower() if len(upper.lower()) == 1 else upper

    return "".join(map(one, text))


class TermFinder:
    """Automata of a document's terms: one for short codes as written, one for the others by folded case."""

    def __init__(self, terms: list[dict]):
        import ahocorasick

        self.sets = {}
        for is_code in (True, False):
            own: dict[str, list[tuple]] = {}
            for t in terms:
                if t["is_code"] == is_code and t["label"]:
                    own.setdefault(t["label"] if is_code else fold_case(t["label"]), []).append((t["sample_index"], t["label"], t["plural"]))
            if own:
                automaton = ahocorasick.Automaton()
                for needle, of in own.items():
                    automaton.add_word(needle, (len(needle), of))
                automaton.make_automaton()
                self.sets[is_code] = automaton

    def find(self, line: str) -> dict[int, set[str]]:
        """Labels found in a line, by sample."""
        found: dict[int, set[str]] = {}
        for is_code, automaton in self.sets.items():
            text = line if is_code else fold_case(line)
            for end, (size, of) in automaton.iter(text):
                if is_code:
                    free = end + 1 - size == 0 or text[end - size] not in _CODE_SIGNS
                    closed = [free and (i >= len(text) or text[i] not in _CODE_SIGNS) for i in (end + 1, end + 2)]
                    closed[1] = closed[1] and text[end + 1:end + 2] == "s"
                for sample, label, plural in of:
                    if not is_code or closed[0] or (plural and closed[1]):
                        found.setdefault(sample, set()).add(label)
        return found


def match_terms(lines: DataFrame, terms: DataFrame) -> DataFrame:
    """Term labels found in each line: the terms of a document meet its lines on the document alone,
    and one pass of an automaton finds all of them."""
    keys = ["run_id", "doc_id"]
    plural = F.contains("pattern", F.lit("(?:s)?(?!"))
    of_doc = terms.withColumn("_part", F.floor(F.col("sample_index") / SAMPLES_AT_ONCE)).groupBy(*keys, "_part").agg(
        F.collect_set(F.struct(F.col("sample_index").cast("int").alias("sample_index"), "label", "is_code", plural.alias("plural"))).alias("_terms"))
    rows = lines.join(of_doc, keys).select(*keys, "chunk_index", "line_index", "line", "_part", "_terms")
    schema = T.StructType([*rows.select(*keys, "chunk_index", "line_index").schema.fields, T.StructField("sample_index", T.IntegerType()),
                           T.StructField("labels", T.ArrayType(T.StringType()))])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = to_arrow_schema(schema)
        known, finder = None, None
        for batch in batches:
            out = []
            places = [batch.column(i).to_pylist() for i in range(6)]
            for i, (run, doc, chunk, at, line, part) in enumerate(zip(*places)):
                if line is None:
                    continue
                if known != (run, doc, part):
                    known, finder = (run, doc, part), TermFinder(batch.column(6)[i].as_py())
                out += [{"run_id": run, "doc_id": doc, "chunk_index": chunk, "line_index": at, "sample_index": sample,
                         "labels": sorted(labels, key=str.encode)} for sample, labels in finder.find(line).items()]
            if out:
                yield pa.RecordBatch.from_pylist(out, shape)

    return rows.mapInArrow(find, schema)

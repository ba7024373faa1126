"""Normalized documents from main-signal answers. One answer is one row; all rules about
its samples work on the array in that row, so nothing is shuffled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.arrays import dedup_by, let
from scholion.functions.text import any_phrase, clean, strip
from scholion.operators.answers import is_valid
from scholion.operators.entities import leaf_text

# Accepted structure labels, forms in order of test, code and name tables.
STRUCTURE_L1 = ("heterocyclic", "partially_heterocyclic", "unmodified_linear", "modified_linear", "conjugated_linear")
STRUCTURE_L2 = {"aromatic": "aromatic", "aliphatic": "aliphatic", "aromatic, aliphatic": "aromatic, aliphatic",
                "aliphatic, aromatic": "aromatic, aliphatic"}
SAMPLE_FORMS = (("aerogel", "Aerogel"), ("film", "Film"), ("membrane", "Membrane"), ("ink", "Ink"),
                ("powder", "Powder"), ("solution", "Solution"), ("solid", "Solid"), ("gel", "Gel"),
                ("fiber", "Fiber"), ("fibre", "Fiber"), ("foam", "Foam"), ("coating", "Coating"))
CODE_ALIASES = {"POLYIMIDE": "PI", "POLYAMIC ACID": "PAA", "POLYAMIC ACID AMMONIUM SALT": "PAAS",
                "CELLULOSE NANOCRYSTAL": "CNC", "CELLULOSE NANOCRYSTALS": "CNC", "PI/AUNPS": "PI/AuNPs",
                "PANI/AUNPS": "PANI/AuNPs"}
CODE_NAMES = {"PI": "Polyimide", "PAA": "Polyamic Acid", "PAAS": "Polyamic Acid Ammonium Salt",
              "CNC": "Cellulose Nanocrystal"}
# Marker words of structure features.
HETEROCYCLIC = ("heterocyclic", "polyimide", "imide", "imidazole", "benzimidazole", "benzoxazole", "oxadiazole",
                "triazine", "pyridine", "pyrrole", "thiophene", "furan")
CONJUGATED = ("conjugated", "polyaniline", "polypyrrole", "polythiophene", "conducting polymer")
PRECURSOR = ("precursor", "oligomer", "trimer", "tetramer", "polyamic acid", "ammonium salt")
MODIFIED = ("modified", "functionalized", "terminated", "substituted", "doped")
AROMATIC = ("aromatic", "phenyl", "benz", "aniline", "phenylene", "diphenyl", "aryl")
ALIPHATIC = ("aliphatic", "cellulose", "alkyl", "cyclohex", "ethylene", "propylene", "polyethylene", "polypropylene")
COMPOSITE = ("/", "composite", "blend", "hybrid", "doped", "nanoparticle", "filled", "alloy")
# Words that make a liquid or ink record generic.
LIQUID_FORMS = ("solution", "gel")
LIQUID_FAMILY = ("precursor", "polyamic acid", "amic acid", "ammonium salt", "salt solution")
LIQUID_TOKENS = ("poly", "polymer", "polymeric", "polyamic", "acid", "amic", "ammonium", "salt", "precursor",
                 "solution", "aqueous", "water", "gel", "resin", "paa", "paas")
INK_COMPONENTS = {"PI": ("polyimide",), "PAA": ("polyamic acid", "paa"),
                  "PAAS": ("polyamic acid ammonium salt", "ammonium salt", "paas"),
                  "CNC": ("cellulose nanocrystal", "cellulose nanocrystals", "cnc"), "PANI": ("polyaniline", "pani")}
INK_TOKENS = ("pure", "neat", "ink", "printing", "printed", "printable", "wt", "cnc", "paa", "paas", "pi", "pani",
              "polyimide", "polyamic", "acid", "ammonium", "salt", "cellulose", "nanocrystal", "nanocrystals",
              "composite")
INK_CONTROLS = ("control", "reference", "blank", "compare", "comparison")


def first_good_prediction(preds: DataFrame) -> DataFrame:
    """First valid record per task in (file, line) order.

    A minimum over a struct combines on the map side, so a task with very many records
    never gathers in one place.
    """
    good = preds.where(is_valid(F.col("parse"), F.col("error")) & (strip(F.col("task_id")) != ""))
    rest = [c for c in preds.columns if c not in ("task_id", "file_order", "seq")]
    return good.groupBy("task_id").agg(F.min_by(F.struct(*rest), F.struct("file_order", "seq")).alias("r")).select(
        "task_id", "r.*")


def normalize_literature_id(text: Column) -> Column:
    """DOI in the form ``doi:<core>``; other identifiers without blanks and closing marks."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", ""), r"[.,;)]+\z", "")
    return let(bare, lambda t: F.when(F.coalesce(
        F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", ""), F.lit("")) != "", (
        F.when(t.rlike(r"(?i)\Ahttps?://doi\.org/"), F.concat(F.lit("doi:"), F.regexp_replace(t, r"(?i)\Ahttps?://doi\.org/", "")))
        .when(t.rlike(r"(?i)\Adoi:"), F.concat(F.lit("doi:"), F.regexp_replace(t, r"(?i)\Adoi:\s*", "")))
        .when(t.rlike(r"(?iU)10\.\d{4,9}/[^\s;]+"), F.concat(F.lit("doi:"), F.regexp_extract(t, r"(?iU)(10\.\d{4,9}/[^\s;]+)", 1)))
        .otherwise(t))))


def split_keywords(items: Column) -> Column:
    """Trimmed keywords, distinct ignoring case; a single entry may hold several, parted by ';'."""
    parts = F.when(F.size(items) == 1, F.split(F.get(items, F.lit(0)), "[;；]")).otherwise(items)
    texts = F.filter(F.transform(F.coalesce(parts, F.array().cast("array<string>")), strip), lambda t: t != "")
    return dedup_by(texts, F.lower)


def normalize_literature(literature: Column) -> Column:
    return F.struct(
        normalize_literature_id(literature["literature_id"]).alias("literature_id"),
        literature["title"].alias("title"),
        F.coalesce(literature["authors"], F.array().cast("array<string>")).alias("authors"),
        literature["journal"].alias("journal"), leaf_text(literature["year"]).alias("year"),
        leaf_text(literature["volume"]).alias("volume"), literature["pages"].alias("pages"),
        literature["document_type"].alias("document_type"), literature["language"].alias("language"),
        split_keywords(literature["keywords"]).alias("keywords"),
    )


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def compact_marks(text: Column) -> Column:
    """No blanks around '/' and '-'."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?U)\s*/\s*", "/"), r"(?U)\s*-\s*", "-"))


def normalize_code(value: Column) -> Column:
    return let(compact_marks(clean(value)), lambda t: F.coalesce(_lookup(CODE_ALIASES, F.upper(t)), t))


def _form_in(lowered: Column) -> Column:
    """First form of the ordered list whose word occurs anywhere in the text."""
    first, *rest = SAMPLE_FORMS
    return reduce(lambda acc, f: acc.when(lowered.contains(f[0]), f[1]), rest,
                  F.when(lowered.contains(first[0]), first[1]))


def structure_features(text: Column) -> tuple[Column, Column]:
    """(L1, L2) inferred from marker words."""
    aromatic, aliphatic = any_phrase(text, AROMATIC), any_phrase(text, ALIPHATIC)
    l1 = (
        F.when(any_phrase(text, CONJUGATED), "conjugated_linear")
        .when(any_phrase(text, HETEROCYCLIC), F.when(any_phrase(text, COMPOSITE) | aliphatic, "partially_heterocyclic")
              .otherwise("heterocyclic"))
        .when(any_phrase(text, PRECURSOR), F.when(any_phrase(text, MODIFIED), "modified_linear")
              .otherwise("unmodified_linear"))
    )
    l2 = F.when(aromatic & aliphatic, "aromatic, aliphatic").when(aromatic, "aromatic").when(aliphatic, "aliphatic")
    return l1, l2


def _joined(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.lower(p), F.lit("")) for p in parts])


def normalize_sample(s: Column) -> Column:
    """Clean fields of one sample; structure labels that are missing are inferred."""
    def given(value: Column, table: dict[str, str]) -> Column:
        raw = clean(value)
        return F.coalesce(_lookup(table, F.lower(raw)), raw)

    def fields(code: Column, name: Column) -> Column:
        raw_form = clean(s["sample_form"])
        l1, l2 = structure_features(_joined(s["name"], s["category_name"], s["category_code"]))
        return F.struct(
            F.coalesce(compact_marks(clean(s["category_name"])), _lookup(CODE_NAMES, code)).alias("category_name"),
            code.alias("category_code"), name.alias("name"),
            F.coalesce(_form_in(F.lower(raw_form)), raw_form, _form_in(F.lower(name))).alias("sample_form"),
            F.coalesce(given(s["structure_l1"], {x: x for x in STRUCTURE_L1}), l1).alias("structure_l1"),
            F.coalesce(given(s["structure_l2"], STRUCTURE_L2), l2).alias("structure_l2"),
            s["aliases"].alias("aliases"),
        )

    name = F.regexp_replace(F.regexp_replace(compact_marks(clean(s["name"])), r"(?U)\(\s+", "("), r"(?U)\s+\)", ")")
    return let(F.struct(normalize_code(s["category_code"]).alias("c"), name.alias("n")),
               lambda v: fields(v["c"], v["n"]))


def normalize_samples(samples: Column) -> Column:
    return F.filter(F.transform(samples, normalize_sample), lambda s: F.coalesce(s["name"], F.lit("")) != "")


# --- rules over all samples of a document

def record_text(s: Column) -> Column:
    return _joined(s["name"], s["category_name"], s["category_code"])


def _form(s: Column) -> Column:
    return F.lower(strip(F.coalesce(s["sample_form"], F.lit(""))))


def _own_tokens(text: Column, generic: tuple[str, ...]) -> Column:
    """Words of three or more letters or digits that are not generic."""
    words = F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0))
    return F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*generic))


def is_generic_liquid(s: Column) -> Column:
    return _form(s).isin(*LIQUID_FORMS) & let(record_text(s), lambda t: (
        any_phrase(t, LIQUID_FAMILY) & ~t.rlike(r"(?U)\d") & ~any_phrase(t, COMPOSITE)
        & (F.size(_own_tokens(t, LIQUID_TOKENS)) == 0)))


def drop_generic_process_liquids(samples: Column) -> Column:
    """Generic precursor liquids go when the document has any sample of another form."""
    return F.when(F.exists(samples, lambda s: ~_form(s).isin(*LIQUID_FORMS)),
                  F.filter(samples, lambda s: ~is_generic_liquid(s))).otherwise(samples)


def component_codes(s: Column) -> Column:
    code = F.coalesce(normalize_code(s["category_code"]), F.lit(""))
    named = F.array_compact(F.array(*[
        F.when(any_phrase(record_text(s), words), F.lit(c)) for c, words in INK_COMPONENTS.items()]))
    return let(code, lambda c: F.when(c != "", F.array_distinct(F.filter(
        F.transform(F.split(c, "/"), lambda p: F.upper(strip(p))), lambda p: p != ""))).otherwise(named))


def is_composite_ink(s: Column) -> Column:
    return (_form(s) == "ink") & ((F.size(component_codes(s)) >= 2) | any_phrase(record_text(s), COMPOSITE))


def drop_generic_inks(samples: Column) -> Column:
    """With two composite inks or more, generic single-component inks of theirs go."""
    def pruned(composites: Column) -> Column:
        parts = F.array_distinct(F.flatten(F.transform(composites, component_codes)))
        return let(parts, lambda known: F.filter(samples, lambda s: ~(
            (_form(s) == "ink") & ~is_composite_ink(s)
            & let(component_codes(s), lambda cs: (F.size(cs) == 1) & (F.size(F.array_except(cs, known)) == 0))
            & ~any_phrase(record_text(s), INK_CONTROLS)
            & (F.size(F.filter(_own_tokens(record_text(s), INK_TOKENS),
                               lambda w: ~w.rlike(r"\A\d+(?:wt)?\z"))) == 0))))

    return let(F.filter(samples, is_composite_ink),
               lambda cs: F.when(F.size(cs) >= 2, pruned(cs)).otherwise(samples))


FILLED = ("category_name", "category_code", "name", "sample_form", "structure_l1", "structure_l2")


def sample_key(s: Column) -> Column:
    return F.concat_ws("\x1f", F.regexp_replace(F.lower(s["name"]), "[^a-z0-9]+", ""),
                       F.coalesce(s["category_code"], F.lit("")), F.coalesce(s["sample_form"], F.lit("")))


def dedupe_samples(samples: Column) -> Column:
    """One sample per key, at its first position; duplicates fill empty fields, and the one
    with more filled fields leads."""
    def score(s: Column) -> Column:
        return reduce(lambda a, f: a + F.when(strip(F.coalesce(s[f], F.lit(""))) != "", 1).otherwise(0),
                      FILLED, F.lit(0))

    def filled(base: Column, other: Column) -> Column:
        return F.struct(*[F.coalesce(F.nullif(base[f], F.lit("")), other[f]).alias(f) for f in FILLED],
                        F.coalesce(base["aliases"], other["aliases"]).alias("aliases"))

    def folded(group: Column) -> Column:
        return F.aggregate(F.slice(group, 2, F.size(group)), F.get(group, F.lit(0)), lambda old, new: F.when(
            score(new) > score(old), filled(new, old)).otherwise(filled(old, new)))

    keyed = F.transform(samples, lambda s: F.struct(sample_key(s).alias("k"), s.alias("s")))
    return let(keyed, lambda ks: F.transform(
        F.array_distinct(F.transform(ks, lambda x: x["k"])),
        lambda k: folded(F.transform(F.filter(ks, lambda x: x["k"] == k), lambda x: x["s"]))))


def number_identities(samples: Column, prefix: Column) -> Column:
    """``<prefix>_<name>_<NN>``, counted per name ignoring case."""
    names = F.transform(samples, lambda s: F.lower(s["name"]))
    return let(names, lambda ns: F.transform(samples, lambda s, i: s.withField("sample_id", F.concat(
        prefix, F.lit("_"), s["name"], F.lit("_"), let(
            F.size(F.filter(F.slice(ns, 1, i + 1), lambda n: n == F.lower(s["name"]))).cast("string"),
            lambda c: F.lpad(c, F.greatest(F.length(c), F.lit(2)), "0"))))))


def normalize_documents(preds: DataFrame, keep_aliases: bool = False) -> DataFrame:
    """(keys, literature, samples) of main-signal records with ``parse``."""
    parse = F.col("parse")
    literature = normalize_literature(parse["literature"])
    samples = F.coalesce(parse["samples"], F.array().cast(preds.schema["parse"].dataType["samples"].dataType))
    staged = preds.withColumn("literature", literature).withColumn("_s", normalize_samples(samples))
    # an ink is never a process liquid, so the two rules do not touch each other
    kept = let(drop_generic_process_liquids(F.col("_s")), drop_generic_inks)
    prefix = F.coalesce(F.nullif(F.col("literature.literature_id"), F.lit("")), F.col("doc_id"))
    final = number_identities(dedupe_samples(F.col("_k")), prefix)
    if not keep_aliases:
        final = F.transform(final, lambda s: s.withField("aliases", F.array().cast("array<string>")))
    keys = [c for c in ("run_id", "doc_id", "task_id", "file_name", "source_refs") if c in preds.columns]
    return staged.withColumn("_k", kept).select(*keys, "literature", final.alias("samples"))

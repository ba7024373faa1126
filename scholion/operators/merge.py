"""Merging repeated answers: leaf by leaf, with aggregates that combine on the map side.

Folding records from left to right has a closed form per leaf. Text keeps the longest
value (the earliest of equally long ones), a number that came first stays, lists keep the
first occurrence of each value. So records are taken apart into leaf rows, reduced per
(key, path) or (key, path, value), and put together again. Repeated answers of one task
may make up any share of the table: none of these steps gathers them in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.functions.arrays import let, sort_by
from scholion.functions.text import any_pattern, has_text, strip
from scholion.operators.answers import is_valid
from scholion.operators.entities import (
    CHARACTERIZATION, CONDITION, EXTRA, MATERIAL, NUMBER, PROPERTY, STEP, TEXT, TEXTS, UNION, Entity,
    table_schema,
)
from scholion.operators.folds import Merge, ordered_fold

# Names of properties that only sum up, and notes of failed measurements.
BROAD_NAMES = (
    r"^thermal\s+stability$", r"^mechanical\s+properties?$", r"^rheological\s+properties?$",
    r"^electrical\s+properties?$", r"^dielectric\s+properties?$", r"^physical\s+properties?$",
    r"^processing\s+properties?$", r"^热稳定性$", r"^力学性能$", r"^流变性能$", r"^电学性能$", r"^介电性能$",
    r"^物理性能$", r"^加工性能$",
)
FAILED_NOTES = (
    r"未能.{0,8}(?:获得|得到).{0,8}(?:准确|可靠).{0,8}(?:测量|结果|数值)",
    r"无法.{0,8}(?:获得|得到|测得).{0,8}(?:准确|可靠).{0,8}(?:测量|结果|数值)",
    r"could\s+not\s+obtain\s+an?\s+accurate\s+(?:measurement|value|result)",
    r"unable\s+to\s+obtain\s+an?\s+accurate\s+(?:measurement|value|result)", r"not\s+measured\s+accurately",
)
# Words that name a supported node, with the product name they give.
SUPPORTED_NODES = (("sensor substrate", "sensor substrate"), ("sensing substrate", "sensing substrate"),
                   ("coated substrate", "coated substrate"), ("substrate", "substrate"), ("electrode", "electrode"),
                   ("sensor", "sensor device"), ("device", "device"))
THIN_FORMS = ("film", "membrane", "coating", "coated", "thin layer")

LEAF = "array<struct<path:string,text:string,is_number:boolean,pos:int>>"


# --- two records

def deep_merge(left: Column, right: Column, entity: Entity) -> Column:
    """Left-to-right merge of two typed records of one shape."""
    def scalar(a: Column, b: Column) -> Column:
        return F.when(~has_text(F.coalesce(a, F.lit(""))), b).when(~has_text(F.coalesce(b, F.lit(""))), a).when(
            F.length(strip(a)) >= F.length(strip(b)), a).otherwise(b)

    def union(a: Column, b: Column) -> Column:
        return F.when(a.isNull(), b).when(b.isNull(), a).when(a["is_number"] | b["is_number"], a).when(
            F.length(strip(a["text"])) >= F.length(strip(b["text"])), a).otherwise(b)

    def one(name: str, kind) -> Column:
        a, b = left[name], right[name]
        if isinstance(kind, Entity):
            return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(deep_merge(a, b, kind))
        if kind == TEXT:
            return scalar(a, b)
        if kind == UNION:
            return union(a, b)
        if kind == NUMBER:
            return F.coalesce(a, b)
        empty = F.slice(F.coalesce(a, b), 1, 0)
        return F.array_distinct(F.concat(F.coalesce(a, empty), F.coalesce(b, empty)))

    fields = [one(name, kind).alias(name) for name, _, kind in entity.fields]
    if entity.open:
        none = F.create_map().cast("map<string,string>")
        a, b = F.coalesce(left[EXTRA], none), F.coalesce(right[EXTRA], none)
        fields.append(F.map_zip_with(a, b, lambda k, x, y: scalar(x, y)).alias(EXTRA))
    return F.struct(*fields)


def prune_empty(rec: Column, entity: Entity) -> Column:
    """Blank texts, empty lists and objects without content become null, at every depth."""
    return let(rec, lambda r: _pruned(r, entity))


def _pruned(rec: Column, entity: Entity) -> Column:
    def one(name: str, kind) -> Column:
        v = rec[name]
        if isinstance(kind, Entity):
            return prune_empty(v, kind)
        if isinstance(kind, list):
            kept = F.filter(F.transform(v, lambda x: prune_empty(x, kind[0])), lambda x: x.isNotNull())
            return let(kept, lambda xs: F.when(F.size(xs) > 0, xs))
        if kind == TEXT:
            return F.when(has_text(v), v)
        if kind == UNION:
            return F.when(has_text(v["text"]), v)
        if kind == NUMBER:
            return v
        return let(F.filter(v, has_text), lambda xs: F.when(F.size(xs) > 0, xs))

    fields = [one(name, kind).alias(name) for name, _, kind in entity.fields]
    names = [name for name, _, _ in entity.fields]
    if entity.open:
        kept = F.map_filter(rec[EXTRA], lambda k, v: has_text(v))
        fields.append(F.when(F.size(kept) > 0, kept).alias(EXTRA))
        names.append(EXTRA)
    return let(F.struct(*fields), lambda s: F.when(
        reduce(lambda a, b: a | b, [s[n].isNotNull() for n in names]), s))


# --- leaf rows

def leaves(rec: Column, entity: Entity, prefix: str = "") -> list[Column]:
    """Arrays of (path, text, is_number, pos); lists of records are left to the caller."""
    def leaf(path, text: Column, is_number: Column, pos: Column) -> Column:
        return F.struct((F.lit(path) if isinstance(path, str) else path).alias("path"), text.alias("text"),
                        is_number.alias("is_number"), pos.cast("int").alias("pos"))

    scalars, parts = [], []
    for name, _, kind in entity.fields:
        value, path = rec[name], prefix + name
        if isinstance(kind, Entity):
            parts += leaves(value, kind, path + ".")
        elif kind == TEXT:
            scalars.append(leaf(path, value, F.lit(False), F.lit(0)))
        elif kind == UNION:
            scalars.append(leaf(path, value["text"], value["is_number"], F.lit(0)))
        elif kind == NUMBER:
            scalars.append(leaf(path, value.cast("string"), F.lit(True), F.lit(0)))
        elif kind == TEXTS:
            parts.append(_list_leaf(value, path, leaf))
    if entity.open:
        extra = F.map_entries(rec[EXTRA])
        parts.append(F.transform(extra, lambda e: leaf(
            F.concat(F.lit(f"{prefix}{EXTRA}."), e["key"]), e["value"], F.lit(False), F.lit(0))))
    return [F.array(*scalars).cast(LEAF)] + [F.coalesce(p, F.array().cast(LEAF)) for p in parts]


def _list_leaf(value: Column, path: str, leaf) -> Column:
    return F.transform(value, lambda x, i: leaf(path, x, F.lit(False), i))


def list_paths(entity: Entity, prefix: str = "") -> list[str]:
    out = []
    for name, _, kind in entity.fields:
        if isinstance(kind, Entity):
            out += list_paths(kind, f"{prefix}{name}.")
        elif kind == TEXTS:
            out.append(prefix + name)
    return out


def rebuild(entity: Entity, scalars: Column, lists: Column, prefix: str = "") -> Column:
    """The typed record from (path -> (text, is_number)) and (path, text) leaves."""
    def one(name: str, kind) -> Column:
        path = prefix + name
        if isinstance(kind, Entity):
            inside = F.exists(F.map_keys(scalars), lambda k: k.startswith(path + ".")) | F.exists(
                lists, lambda x: x["path"].startswith(path + "."))
            return F.when(inside, rebuild(kind, scalars, lists, path + "."))
        found = F.try_element_at(scalars, F.lit(path))
        if kind == TEXT:
            return found["text"]
        if kind == UNION:
            return F.when(found.isNotNull(), F.struct(found["text"].alias("text"), found["is_number"].alias("is_number")))
        if kind == NUMBER:
            return found["text"].cast("double")
        if kind == TEXTS:
            return F.transform(F.filter(lists, lambda x: x["path"] == path), lambda x: x["text"])
        return F.array().cast(T.ArrayType(table_schema(kind[0])))

    fields = [one(name, kind).alias(name) for name, _, kind in entity.fields]
    if entity.open:
        mark = f"{prefix}{EXTRA}."
        own = F.map_filter(scalars, lambda k, v: k.startswith(mark))
        fields.append(F.transform_values(
            F.transform_keys(own, lambda k, v: F.substr(k, F.lit(len(mark) + 1))),
            lambda k, v: v["text"]).alias(EXTRA))
    return F.struct(*fields)


def merge_leaves(rows: DataFrame, keys: list[str], rec: str, entity: Entity, out: str) -> DataFrame:
    """One merged record per key from rows with ``keys``, ``ord`` and a record column.

    Also gives ``first_ord``, the order of the first row of the key.
    """
    parts = F.filter(F.concat(*leaves(F.col(rec), entity)), lambda x: has_text(F.coalesce(x["text"], F.lit(""))))
    # a row without any leaf still stands for its key
    mark = F.array(F.struct(F.lit("").alias("path"), F.lit("").alias("text"), F.lit(False).alias("is_number"),
                            F.lit(0).alias("pos")).cast("struct<path:string,text:string,is_number:boolean,pos:int>"))
    long = rows.select(*keys, "ord", F.explode(F.concat(mark, parts)).alias("l")).select(*keys, "ord", "l.*")
    several = list_paths(entity)
    is_list = F.col("path").isin(*several) if several else F.lit(False)
    # list values are grouped by value too; scalars share one group per path
    grouped = long.withColumn("value_key", F.when(is_list, F.col("text"))).groupBy(*keys, "path", "value_key").agg(
        F.min(F.struct("ord", "pos")).alias("at"),
        F.min_by("is_number", "ord").alias("first_number"),
        F.min_by("text", "ord").alias("first_text"),
        F.min_by(F.when(~F.col("is_number"), F.col("text")),
                 F.when(~F.col("is_number"), F.struct((-F.length(strip(F.col("text")))).alias("n"), "ord")))
        .alias("longest"),
    )
    value = F.when(is_list | F.col("first_number"), F.col("first_text")).otherwise(F.col("longest"))
    entry = F.struct("at", "path", value.alias("text"), F.col("first_number").alias("is_number"), is_list.alias("is_list"))
    joined = grouped.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("xs"))
    scalars = F.map_from_entries(F.transform(
        F.filter("xs", lambda x: ~x["is_list"] & (x["path"] != "")), lambda x: F.struct(
            x["path"], F.struct(x["text"].alias("text"), x["is_number"].alias("is_number")))))
    lists = F.transform(F.filter("xs", lambda x: x["is_list"]),
                        lambda x: F.struct(x["path"].alias("path"), x["text"].alias("text")))
    made = let(F.struct(scalars.alias("s"), lists.alias("l")), lambda v: rebuild(entity, v["s"], v["l"]))
    return joined.select(*keys, F.array_min(F.transform("xs", lambda x: x["at"]["ord"])).alias("first_ord"),
                         made.alias(out))


# --- routes

def valid_predictions(preds: DataFrame) -> DataFrame:
    return preds.where(is_valid(F.col("parse"), F.col("error")) & has_text(F.coalesce("task_id", F.lit(""))))


def with_record_count(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``n_records``: the number of records per key."""
    return rows.join(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records")), keys)


def merge_characterizations(rows: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """Rows (keys, ord, payload) to one characterization record per key."""
    return merge_leaves(rows, keys, payload, CHARACTERIZATION, payload).drop("first_ord")


def key_text(value: Column) -> Column:
    return F.lower(strip(F.coalesce(value, F.lit(""))))


def _entries(rows: DataFrame, keys: list[str], payload: str, always: bool) -> DataFrame:
    """One row per entry, with its order; entries of single records keep apart by position."""
    counted = with_record_count(rows, keys)
    apart = F.lit(False) if always else F.col("n_records") < 2
    return counted.select(*keys, "n_records", F.posexplode(payload).alias("pos", "e"), "ord").select(
        *keys, "n_records", F.struct("ord", "pos").alias("ord"), "e",
        F.when(apart, F.col("pos")).otherwise(F.lit(-1)).alias("entry_id"))


def merge_properties(rows: DataFrame, keys: list[str], payload: str = "payload", always: bool = False) -> DataFrame:
    """Entries with equal category, name and abbreviation merge; weak ones are dropped.

    Both happen only where a key has at least two records, unless ``always``.
    """
    entries = _entries(rows, keys, payload, always).select(
        *keys, "n_records", "ord", "e", "entry_id",
        key_text(F.col("e.category")).alias("k1"), key_text(F.col("e.name")).alias("k2"),
        key_text(F.col("e.abbreviation")).alias("k3"))
    merged = merge_leaves(entries, [*keys, "n_records", "entry_id", "k1", "k2", "k3"], "e", PROPERTY, "e")
    grouped = merged.groupBy(*keys, "n_records").agg(
        F.transform(sort_by(F.collect_list(F.struct("first_ord", "e")), "first_ord"), lambda x: x["e"]).alias("es"))
    apply = F.lit(True) if always else F.col("n_records") > 1
    made = grouped.select(*keys, F.when(apply, drop_weak_properties(F.col("es"))).otherwise(F.col("es")).alias(payload))
    empty = rows.select(*keys).distinct()
    return empty.join(made, keys, "left").withColumn(
        payload, F.coalesce(payload, F.array().cast(T.ArrayType(table_schema(PROPERTY)))))


def is_broad(name: Column) -> Column:
    return F.regexp_like(key_text(name), F.lit("(?iU)" + "|".join(f"(?:{p})" for p in BROAD_NAMES)))


def has_number(value: Column) -> Column:
    return reduce(lambda a, b: a | b, [value[n].isNotNull() for n in ("single", "minimum", "maximum", "error")])


def drop_weak_properties(entries: Column) -> Column:
    """Failed-measurement notes and broad summaries beside a specific peer go, unless they
    hold a number."""
    specific = F.transform(
        F.filter(entries, lambda p: (key_text(p["name"]) != "") & ~is_broad(p["name"])), lambda p: key_text(p["category"]))

    def weak(p: Column, categories: Column) -> Column:
        failed = any_pattern(F.coalesce(key_text(p["value"]["note"]), F.lit("")), FAILED_NOTES)
        summary = is_broad(p["name"]) & F.array_contains(categories, key_text(p["category"]))
        return ~F.coalesce(has_number(p["value"]), F.lit(False)) & (failed | summary)

    return let(F.array_distinct(specific), lambda cs: F.filter(entries, lambda p: ~weak(p, cs)))


def merge_process_steps(rows: DataFrame, keys: list[str], payload: str = "payload", always: bool = False) -> DataFrame:
    """Steps with equal product merge, with their materials, conditions and post-processing.

    Happens only where a key has at least two records, unless ``always``.
    """
    step_keys = [*keys, "entry_id", "k1"]
    steps = _entries(rows, keys, payload, always).withColumn("k1", key_text(F.col("e.product_name")))
    scalar_step = Entity(tuple(f for f in STEP.fields if f[0] not in ("materials", "conditions", "post_processing")))
    heads = merge_leaves(steps, step_keys, "e", scalar_step, "head")

    def parts(name: str, entity: Entity, key_fields: tuple[str, ...]) -> DataFrame:
        rows = steps.select(*step_keys, F.posexplode(f"e.{name}").alias("i", "p"), F.col("ord").alias("o")).select(
            *step_keys, F.struct("o", "i").alias("ord"), "p",
            *[key_text(F.col(f"p.{f}")).alias(f"m{n}") for n, f in enumerate(key_fields)],
            F.when(F.col("entry_id") >= 0, F.col("i")).otherwise(F.lit(-1)).alias("part_id"))
        names = [f"m{n}" for n in range(len(key_fields))]
        merged = merge_leaves(rows, [*step_keys, "part_id", *names], "p", entity, "p")
        return merged.groupBy(*step_keys).agg(F.transform(
            sort_by(F.collect_list(F.struct("first_ord", "p")), "first_ord"), lambda x: x["p"]).alias(name))

    # values of the last record join by exact text, earlier ones ignoring case
    last = steps.groupBy(*step_keys).agg(F.max("ord").alias("last_ord"))
    post = steps.select(*step_keys, "ord", F.posexplode("e.post_processing").alias("i", "v")).join(last, step_keys)
    firsts = post.withColumn("is_last", F.col("ord") == F.col("last_ord")).groupBy(
        *step_keys, "is_last", F.lower("v").alias("lv")).agg(F.min(F.struct("ord", "i", "v")).alias("f"))
    distinct = firsts.groupBy(*step_keys, F.col("f.v").alias("v")).agg(F.min("f").alias("f"))
    posts = distinct.groupBy(*step_keys).agg(F.transform(
        F.array_sort(F.collect_list("f")), lambda x: x["v"]).alias("post_processing"))

    joined = heads
    for table in (parts("materials", MATERIAL, ("name", "material_class", "material_type", "abbreviation")),
                  parts("conditions", CONDITION, ("device", "procedure", "conditions")), posts):
        joined = joined.join(table, step_keys, "left")
    step = F.struct(*[
        (F.coalesce(F.col(name), F.array().cast(table_schema(STEP)[name].dataType))
         if name in ("materials", "conditions", "post_processing") else F.col(f"head.{name}")).alias(name)
        for name, _, _ in STEP.fields])
    made = joined.groupBy(*keys).agg(F.transform(
        sort_by(F.collect_list(F.struct("first_ord", step.alias("s"))), "first_ord"), lambda x: x["s"]).alias(payload))
    return rows.select(*keys).distinct().join(made, keys, "left").withColumn(
        payload, F.coalesce(payload, F.array().cast(T.ArrayType(table_schema(STEP)))))


PAYLOAD_FIELD = {"char": "characterization", "prop": "properties", "proc": "steps"}
MERGE = {"char": merge_characterizations, "prop": merge_properties, "proc": merge_process_steps}


def merge_predictions(preds: DataFrame, route: str | Merge, **options) -> DataFrame:
    """All valid records of a task merged in (file, line) order: (task_id, payload).

    ``route`` names one of the routes, or is a function that merges two whole records given as dicts.
    """
    whole = callable(route)
    rows = valid_predictions(preds).select("task_id", F.struct("file_order", "seq").alias("ord"), (
        F.col("parse") if whole else F.col(f"parse.{PAYLOAD_FIELD[route]}")).alias("payload"))
    return ordered_fold(rows, ["task_id"], "ord", "payload", route, **options) if whole else MERGE[route](rows, ["task_id"], **options)


def after_stage(tasks: DataFrame, preds: DataFrame, route: str, **options) -> DataFrame:
    """Tasks that have a merged payload, ready for the final merge."""
    merged = merge_predictions(preds, route, **options)
    keep = ["run_id", "doc_id", "sample_id", "task_id"]
    if route != "proc":
        return tasks.select(*keep).join(merged, "task_id").select(*keep, "payload")
    joined = tasks.join(merged, "task_id")
    return supplement_supported_node(joined).select(*keep, "payload")


def after_counts(tasks: DataFrame, preds: DataFrame) -> DataFrame:
    """Counters of an after stage as (metric, value) rows."""
    per_task = valid_predictions(preds).groupBy("task_id").agg(F.count(F.lit(1)).alias("n"))
    joined = tasks.select("task_id", F.lit(1).alias("is_task")).join(per_task, "task_id", "full")
    n = F.col("n")
    return as_metrics(joined.agg(
        F.count("is_task").alias("total_task_count"),
        F.coalesce(F.sum(n), F.lit(0)).alias("good_predict_record_count"),
        F.count(F.when(F.col("is_task").isNotNull(), n)).alias("matched_task_count"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("merged_duplicate_count"),
        F.count(F.when(n.isNull(), 1)).alias("missing_predict_count"),
    ))


def as_metrics(one_row: DataFrame) -> DataFrame:
    """The columns of a one-row table as (metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(*pairs)).alias("m")).select("m.*")


def supplement_supported_node(rows: DataFrame) -> DataFrame:
    """A thin or coated sample with its own step but no substrate, electrode, sensor or
    device step gets one, named from its support passages or the task text."""
    words = [w for w, _ in SUPPORTED_NODES]

    def first_label(text: Column) -> Column:
        return reduce(lambda acc, p: acc.when(text.contains(p[0]), p[1]), SUPPORTED_NODES[1:],
                      F.when(text.contains(SUPPORTED_NODES[0][0]), SUPPORTED_NODES[0][1]))

    def any_word(text: Column) -> Column:
        return text.rlike("|".join(words))

    anchor, steps = F.col("anchor"), F.col("payload")
    names = F.transform(steps, lambda s: key_text(s["product_name"]))
    terms = F.filter(F.array(*[key_text(anchor[f]) for f in ("name", "category_code", "category_name")]),
                     lambda t: t != "")
    own = F.exists(names, lambda n: F.exists(terms, lambda t: n.contains(t)))
    thin = key_text(anchor["sample_form"]).rlike("|".join(THIN_FORMS))
    refs = F.filter("source_refs", lambda r: r["route_role"] == "process_support")
    from_refs = F.get(F.array_compact(F.transform(refs, lambda r: first_label(F.concat_ws(
        " ", key_text(r["segment_title"]), key_text(r["section_title"]))))), F.lit(0))
    staged = rows.withColumn("_node", F.when(
        thin & own & ~F.exists(names, any_word), F.coalesce(from_refs, first_label(key_text(F.col("text"))))))
    source = F.get(F.filter(refs, lambda r: key_text(r["segment_title"]).contains(F.col("_node"))
                            | any_word(key_text(r["segment_title"]))), F.lit(0))
    location = let(source, lambda r: F.when(r.isNotNull(), F.struct(
        r["block_id"].alias("block_id"),
        F.concat(F.lit("line "), r["line_span"][0].cast("string"), F.lit("-"), r["line_span"][1].cast("string"))
        .alias("md_range"), F.lit(None).cast("string").alias("text"))))
    kind = table_schema(STEP)
    extra = F.struct(*[
        (F.col("_node") if f.name == "product_name" else location if f.name == "location" else
         F.array().cast(f.dataType) if isinstance(f.dataType, T.ArrayType) else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in kind.fields])
    return staged.withColumn("payload", F.when(
        F.col("_node").isNotNull(), F.concat(steps, F.array(extra.cast(kind)))).otherwise(steps)).drop("_node")

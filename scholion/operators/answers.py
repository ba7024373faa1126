"""Answers of the model: repair, typed reading, validation, status, chunk assembly."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholion.functions.arrays import dedup_ignore_case, let
from scholion.functions.text import WHITESPACE, has_text, strip
from scholion.operators.entities import EXTRA, NUMBER, TEXT, TEXTS, UNION, Entity, table_schema

# The three kinds of error text.
NO_JSON, BAD_JSON, BAD_MODEL = "未找到有效的JSON内容", "JSON解析错误: ", "模型验证错误: "
STRING = r'"(?:\\.|[^"\\])*"'
#: What a text that was cut off may end with after its last complete member.
CUT_MEMBER = r'(?s)(?:,\s*|(?<=[{\[])\s*)(?:"(?:\\.|[^"\\])*"?\s*:?\s*)?[^\s"{}\[\],:]*\s*\z'


#: Depth up to which one regex finds the end of an object; deeper ones are followed mark by mark.
PLAIN_DEPTH = 10


def _balanced(depth: int) -> str:
    """A bracket up to the one that closes it, with at most so many levels inside; never backtracks."""
    inside = r'[^"{}\[\]]++|"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    return rf'[{{\[](?:{inside}{f"|{_balanced(depth - 1)}" if depth else ""})*+[}}\]]'


def _unclosed(body: Column) -> Column:
    """The marks that close what the text leaves open, innermost first.

    One pass over the marks with a stack of those that are open, however deep.
    """
    marks = F.regexp_replace(F.regexp_replace(body, STRING, ""), r'[^\[\]{}"]', "")

    def step(stack: Column, mark: Column) -> Column:
        paired = (stack.endswith("{") & (mark == "}")) | (stack.endswith("[") & (mark == "]"))
        return F.when(paired, F.left(stack, F.length(stack) - 1)).otherwise(F.concat(stack, mark))

    left = F.aggregate(F.split(marks, ""), F.lit(""), step)
    return F.translate(F.reverse(F.regexp_replace(left, r"[\]}]", "")), '{["', '}]"')


def _first_object(body: Column) -> Column:
    """The text up to the bracket that closes its first one; null if none does."""
    pieces = F.regexp_extract_all(body, F.lit(rf'{STRING}|[{{}}\[\]]|[^"{{}}\[\]]+|"'), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("length"), F.lit(False).alias("closed"))

    def step(at: Column, piece: Column) -> Column:
        depth = at["depth"] + F.when(piece.isin("{", "["), 1).when(piece.isin("}", "]"), -1).otherwise(0)
        return F.when(at["closed"], at).otherwise(F.struct(
            depth.alias("depth"), (at["length"] + F.length(piece)).alias("length"), (depth <= 0).alias("closed")))

    followed = let(F.aggregate(pieces, start, step), lambda at: F.when(at["closed"], F.left(body, at["length"])))
    return let(F.regexp_extract(body, f"\\A{_balanced(PLAIN_DEPTH)}", 0), lambda found: F.when(found != "", found).otherwise(followed))


def repair_json(text: Column) -> Column:
    """The JSON object inside a text with the common breakages mended; null without one.

    Text around the first complete object (prose, code fences) is cut off and trailing commas
    are dropped. Where the object is cut off, an open string and open brackets are closed, at
    the end or else after the last complete member.
    """
    def tidy(body: Column) -> Column:
        mended = F.regexp_replace(body, rf"({STRING})|,(?=\s*[}}\]])", "$1")
        return F.when(body.rlike(r",\s*[}\]]"), mended).otherwise(body)

    def closed(body: Column) -> Column:
        return F.concat(body, _unclosed(body))

    def open_ended(body: Column) -> Column:
        return F.regexp_replace(body, r"(?s)\s*```\s*\z", "")

    def mended(body: Column) -> Column:
        cut_off = let(open_ended(body), lambda rest: let(let(closed(rest), tidy), lambda whole: F.when(
            F.try_parse_json(whole).isNotNull(), whole).otherwise(
            let(closed(F.regexp_replace(rest, CUT_MEMBER, "")), tidy))))
        return let(_first_object(body), lambda whole: F.when(whole.isNotNull(), tidy(whole)).otherwise(cut_off))

    start = F.instr(text, "{")
    return F.when(start > 0, let(F.substr(text, start), mended))


def _shallow(entity: Entity) -> T.StructType:
    """One level of an object: nested objects stay JSON text."""
    def one(kind) -> T.DataType:
        if kind == TEXT or isinstance(kind, Entity):
            return T.StringType()
        if isinstance(kind, list):
            return T.ArrayType(T.StringType())
        return T.VariantType()

    return T.StructType([T.StructField(key, one(kind)) for _, key, kind in entity.fields])


def _text_list(value: Column) -> Column:
    """A list of distinct trimmed texts from a JSON array or a single (';'-separated) value."""
    as_list = F.try_variant_get(value, "$", "array<string>")
    single = F.split(F.try_variant_get(value, "$", "string"), "[;；]")
    none = F.array().cast("array<string>")
    return F.when(value.isNull(), none).otherwise(dedup_ignore_case(F.filter(
        F.transform(F.coalesce(as_list, single, none), strip),
        lambda t: t.isNotNull() & (t != ""))))


def _filled(value: Column) -> Column:
    """Trimmed text, null where nothing is left. ``value`` must be cheap: it is mentioned several times."""
    space = F.lit(WHITESPACE)
    blank_edge = space.contains(F.left(value, F.lit(1))) | space.contains(F.right(value, F.lit(1)))
    return F.when(value.isNotNull(), F.when(blank_edge, F.nullif(F.btrim(value, space), F.lit(""))).otherwise(value))


def _union(value: Column) -> Column:
    return F.when(value.isNotNull(), let(let(F.try_variant_get(value, "$", "string"), _filled), lambda text: F.when(
        text.isNotNull(), F.struct(
            text.alias("text"), (F.schema_of_variant(value) != "STRING").alias("is_number")))))


def read_record(text: Column, entity: Entity, path: str = "") -> Column:
    """struct(rec, errs): the typed record of a JSON object text and what is wrong with it."""
    none = F.array().cast("array<string>")

    def level(s: Column, keys: Column) -> Column:
        fields, errs = [], []
        for name, key, kind in entity.fields:
            value = s[key]
            label = f"{path}{name}"
            if kind == TEXT:
                out = _filled(value)
            elif kind == UNION:
                out = _union(value)
            elif kind == NUMBER:
                raw = F.when(value.isNotNull(), let(F.try_variant_get(value, "$", "string"), _filled))
                out = raw.try_cast("double")
                errs.append(F.when(value.isNotNull(), F.when(
                    raw.isNotNull() & out.isNull(), F.array(F.lit(f"{label}: not a number")))))
            elif kind == TEXTS:
                out = _text_list(value)
            else:
                fields.append((name, kind, value))
                continue
            fields.append((name, None, out))
            if name in entity.required:
                errs.append(F.when(out.isNull(), F.array(F.lit(f"{label}: missing"))))
        plain = [(n, v) for n, k, v in fields if k is None]
        nested = [(n, k, v) for n, k, v in fields if k is not None]
        children = [
            (read_record(v, k, f"{path}{n}.") if isinstance(k, Entity) else _record_list(v, k[0], f"{path}{n}."))
            .alias(n) for n, k, v in nested
        ]
        for n, k, v in nested:
            if n in entity.required and isinstance(k, Entity):
                errs.append(F.when(v.isNull(), F.array(F.lit(f"{path}{n}: missing"))))
        if entity.strict:
            extra = F.array_except(keys, F.array(*[F.lit(key) for _, key, _ in entity.fields]))
            errs.append(F.transform(extra, lambda k: F.concat(F.lit(f"{path}"), k, F.lit(": unknown key"))))

        def assemble(c: Column | None) -> Column:
            by_name = {n: v for n, v in plain}
            deep = []
            for n, k, _ in nested:
                if isinstance(k, Entity):
                    by_name[n] = c[n]["rec"]
                    deep.append(c[n]["errs"])
                else:
                    by_name[n] = F.transform(c[n], lambda r: r["rec"])
                    deep.append(F.flatten(F.transform(c[n], lambda r: r["errs"])))
            rec = [by_name[n].alias(n) for n, _, _ in entity.fields]
            if entity.open:
                rec.append(_extras(text, entity).alias(EXTRA))
            all_errs = [F.coalesce(e, none) for e in errs + deep]
            return F.struct(F.struct(*rec).alias("rec"), F.concat(*all_errs, none).alias("errs"))

        return let(F.struct(*children), assemble) if children else assemble(None)

    def named(t: Column) -> Column:
        renamed = t
        if entity.renames:
            told = reduce(lambda a, b: a | b, [t.contains(f'"{old}"') for old in entity.renames])
            renamed = F.when(told, reduce(lambda x, pair: F.regexp_replace(x, f'"{pair[0]}"(\\s*:)', f'"{pair[1]}"$1'),
                                          entity.renames.items(), t)).otherwise(t)

        def read(x: Column) -> Column:
            keys = F.coalesce(F.json_object_keys(x), none) if entity.strict else none
            return let(F.struct(F.from_json(x, _shallow(entity)).alias("s"), keys.alias("keys")),
                       lambda p: level(p["s"], p["keys"]))

        return let(renamed, read) if entity.renames else read(renamed)

    kind = T.StructType([T.StructField("rec", table_schema(entity)), T.StructField("errs", T.ArrayType(T.StringType()))])
    return F.when(text.isNotNull(), named(text)).otherwise(
        F.struct(F.lit(None).cast(kind["rec"].dataType).alias("rec"), none.alias("errs")))


def _record_list(texts: Column, entity: Entity, path: str) -> Column:
    return F.transform(F.coalesce(texts, F.array().cast("array<string>")), lambda t: read_record(t, entity, path))


def _extras(text: Column, entity: Entity) -> Column:
    known = [F.lit(k) for _, k, _ in entity.fields] + [F.lit(k) for k in entity.renames]
    pairs = F.map_filter(F.from_json(text, "map<string,string>"), lambda k, v: ~k.isin(*known) & has_text(v))
    return F.transform_values(pairs, lambda k, v: strip(v))


def parse_responses(df: DataFrame, entity: Entity, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Add ``parse`` (typed record) and ``error`` to rows with ``raw_text``.

    A call that already failed keeps its error. ``rules`` are (message, condition that must
    hold) pairs over ``parse``.
    """
    prior = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    kept = [c for c in df.columns if c not in ("error", "parse")]
    body = df.select(*kept, prior.alias("_prior"), _once(repair_json(F.col("raw_text")), "_json"))
    well_formed = F.coalesce(F.try_parse_json("_json").isNotNull(), F.lit(False))
    read = F.when(well_formed, read_record(F.col("_json"), entity))
    staged = body.select(*kept, "_prior", "_json", _once(read, "_read")).withColumn("parse", F.col("_read.rec"))
    errs = F.col("_read.errs")
    if rules:
        errs = F.concat(errs, F.array_compact(F.array(*[
            F.when(~F.coalesce(ok, F.lit(True)), F.lit(m)) for m, ok in rules])))
    error = (
        F.when(F.col("_prior") != "", F.col("_prior"))
        .when(F.col("_json").isNull(), F.lit(NO_JSON))
        .when(F.col("_read").isNull(), F.concat(F.lit(BAD_JSON), F.col("_json")))
        .when(F.size(errs) > 0, F.concat(F.lit(BAD_MODEL), F.array_join(errs, "; ")))
    )
    return staged.select(*kept, "parse", error.alias("error")).withColumn(
        "parse", F.when(F.col("error").isNull(), F.col("parse")))


def _once(value: Column, name: str) -> Column:
    """A generator column: filters on it later cannot be pushed below, where the costly
    expression would be evaluated again for each mention."""
    return F.stack(F.lit(1), value).alias(name)


def is_valid(parse: Column, error: Column) -> Column:
    return parse.isNotNull() & ~has_text(F.coalesce(error, F.lit("")))


def status_of(parse: Column, error: Column) -> Column:
    """ok, parse_error (an error is recorded) or invoke_error."""
    return F.when(is_valid(parse, error), "ok").when(F.coalesce(error, F.lit("")) != "", "parse_error").otherwise("invoke_error")


def with_status(preds: DataFrame) -> DataFrame:
    """Add ``status``."""
    return preds.withColumn("status", status_of(F.col("parse"), F.col("error")))


def prediction_status(preds: DataFrame) -> DataFrame:
    return with_status(preds).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def recover_raw_text(preds: DataFrame, entity: Entity) -> DataFrame:
    """Count a failed record whose raw text is itself a valid answer (no repair)."""
    strict = F.when(F.try_parse_json("raw_text").isNotNull() & F.ltrim("raw_text").startswith("{"), F.col("raw_text"))
    read = F.when(~is_valid(F.col("parse"), F.col("error")), read_record(strict, entity))
    staged = preds.select("*", _once(read, "_r"))
    good = F.col("_r.rec").isNotNull() & (F.size("_r.errs") == 0)
    return staged.withColumn("parse", F.when(good, F.col("_r.rec")).otherwise(F.col("parse"))).withColumn(
        "error", F.when(~good | good.isNull(), F.col("error"))).drop("_r")


# --- answers that arrive in chunks

BLOCK = 4096


def running_counts(chunks: DataFrame, key: str, order: str, counts: dict[str, Column]) -> DataFrame:
    """Running sums per key, in two levels: blocks of rows, then inside each block.

    One key may own any share of the rows; its blocks spread over the cluster.
    """
    blocked = chunks.withColumns(counts).withColumn("_block", F.floor(F.col(order) / BLOCK))
    inside = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy(key, "_block").agg(*[F.sum(c).alias(c) for c in counts])
    shifts = sums.select(key, "_block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_b_{c}") for c in counts])
    joined = blocked.withColumns({f"_r_{c}": F.sum(c).over(inside) for c in counts}).join(shifts, [key, "_block"])
    return joined.withColumns({c: F.col(f"_r_{c}") + F.col(f"_b_{c}") for c in counts}).select(
        *chunks.columns, *counts)


def looks_complete(opens: Column, closes: Column, square_opens: Column, square_closes: Column) -> Column:
    """Braces (or brackets) are present and none is left open."""
    return ((opens > 0) & (closes > 0) & (closes >= opens)) | (
        (square_opens > 0) & (square_closes > 0) & (square_closes >= square_opens))


def assemble_chunks(chunks: DataFrame, entity: Entity, key: str = "response_id") -> DataFrame:
    """Each new distinct successful reading of a growing response, and its end.

    The reading can only change at a chunk with a closing bracket, so other prefixes are
    not tried. A response's text is put together once; prefixes are cut from it.
    """
    def occurrences(mark: str) -> Column:
        return F.length("chunk") - F.length(F.replace(F.col("chunk"), F.lit(mark), F.lit("")))

    counted = running_counts(chunks, key, "seq", {
        "n_chars": F.length("chunk"), "opens": occurrences("{"), "closes": occurrences("}"),
        "square_opens": occurrences("["), "square_closes": occurrences("]")})
    tried = counted.withColumn("try", F.col("chunk").rlike(r"[}\]]") & looks_complete(
        F.col("opens"), F.col("closes"), F.col("square_opens"), F.col("square_closes")))
    texts = tried.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", "chunk", "n_chars", "try"))).alias("cs"))
    prefixes = texts.select(
        key, F.array_join(F.col("cs.chunk"), "").alias("full"),
        F.array_max("cs.seq").alias("last_seq"),
        F.explode(F.filter("cs", lambda c: c["try"] | (c["seq"] == F.element_at("cs", -1)["seq"]))).alias("c"),
    ).select(key, F.col("c.seq").alias("seq"), (F.col("c.seq") == F.col("last_seq")).alias("is_final"),
             F.expr("substring(full, 1, cast(c.n_chars AS int))").alias("raw_text"))
    read = parse_responses(prefixes, entity).withColumn("answer", F.to_json("parse"))
    by_seq = Window.partitionBy(key).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return read.withColumn("previous", F.last("answer", ignorenulls=True).over(by_seq)).where(
        (F.col("answer").isNotNull() & (F.col("previous").isNull() | (F.col("previous") != F.col("answer"))))
        | (F.col("is_final") & F.col("previous").isNull())
    ).drop("previous")

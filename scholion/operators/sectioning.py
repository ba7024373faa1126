"""Documents to sections: all work on one document happens inside its own row,
so splitting a corpus needs no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholion.functions.arrays import let, span
from scholion.functions.text import RARE_BREAK, has_text, is_blank, split_lines, strip
from scholion.sources.corpus import dense_index

# Heading and outline number shapes, and the names of unnamed sections.
HEADING = r"(?sU)^(#{1,6})[ \t]+(.+?)\s*\z"
STRIPPED_HEADING = r"(?sU)^\s*#{1,6}[ \t]+.*\S"
OUTLINE = r"(?U)^(\d+(?:\.\d+)*)(?:\.(?=[^\d]|\z)|\s+|\z)"
FULL_TEXT, PREFACE, UNTITLED = "__FULL_TEXT__", "__PREFACE__", "__UNTITLED__"


def normalize_raw(raw: DataFrame, order_by: str = "file_name", strict: bool = False) -> DataFrame:
    """(doc_index, doc_id, file_name, content, md5_fallback) with the missing parts filled in."""
    if strict:
        complete = F.col("file_name").isNotNull() & F.col("content").isNotNull() & F.col("md5").isNotNull()
        lacking = F.raise_error(F.concat(F.lit("missing file_name, md5 or content near "), F.coalesce(F.col(order_by).cast("string"), F.lit("?"))))
        raw = raw.where(F.when(complete, True).otherwise(lacking.cast("boolean")))
    content = F.coalesce(F.col("content").cast("string"), F.lit(""))
    fallback = is_blank(F.col("md5"))
    numbered = dense_index(raw, order_by, "doc_index", tie=[c for c in ("file_name", "md5") if c != order_by])
    return numbered.select(
        "doc_index",
        F.when(fallback, F.md5(content.cast("binary"))).otherwise(F.lower(strip(F.col("md5")))).alias("doc_id"),
        F.when(is_blank(F.col("file_name")), F.concat(F.lit("unknown_"), F.col("doc_index").cast("string")))
        .otherwise(F.col("file_name")).alias("file_name"),
        content.alias("content"),
        fallback.alias("md5_fallback"),
    )


def heading_struct(line: Column, index: Column) -> Column:
    """What a heading line says: levels, title, number."""
    return let(
        strip(F.regexp_extract(line, HEADING, 2)),
        lambda title: let(
            F.regexp_extract(title, OUTLINE, 1),
            lambda number: F.struct(
                index.alias("line"),
                F.length(F.regexp_extract(line, HEADING, 1)).alias("level"),
                title.alias("title"),
                F.nullif(number, F.lit("")).alias("number"),
                F.when(number != "", F.size(F.split(number, r"\."))).alias("outline"),
            ),
        ),
    )


def headings_of(lines: Column) -> Column:
    """Array of heading structs of an array of lines."""
    marked = F.transform(lines, lambda x, i: F.when(x.rlike(HEADING), heading_struct(x, i)))
    return F.array_compact(marked)


def detect_headings(docs: DataFrame) -> DataFrame:
    """One row per heading: (doc_id, line_index, header_level, title, section_number, outline_level)."""
    return (
        docs.select("doc_id", F.explode(headings_of(F.split("content", "\n", -1))).alias("h"))
        .select(
            "doc_id",
            F.col("h.line").alias("line_index"),
            F.col("h.level").alias("header_level"),
            F.col("h.title").alias("title"),
            F.col("h.number").alias("section_number"),
            F.col("h.outline").alias("outline_level"),
        )
    )


def _named(line: Column, level: Column, rank: Column, title: Column, number: Column) -> Column:
    return F.struct(
        line.cast("int").alias("line"),
        level.cast("int").alias("header_level"),
        rank.cast("int").alias("title_level"),
        F.when(title == "", F.lit(UNTITLED)).otherwise(title).alias("title"),
        number.alias("number"),
    )


def split_starts(lines: Column) -> Column:
    """Where sections start and how they are named, before heading-only ones are merged.

    Sections open at headings that are unnumbered or numbered at level 1; the first one
    also takes the text before it. If every heading is numbered deeper, each opens a
    section and the text before the first becomes a preface. No heading: one section.
    """
    none = F.lit(None).cast("string")
    whole = F.array(_named(F.lit(0), F.lit(0), F.lit(0), F.lit(FULL_TEXT), none))
    preface = F.array(_named(F.lit(0), F.lit(0), F.lit(0), F.lit(PREFACE), none))

    def by_heads(heads: Column) -> Column:
        top = F.filter(heads, lambda h: h["outline"].isNull() | (h["outline"] == 1))
        by_top = let(top, lambda hs: F.transform(
            hs,
            lambda h, k: _named(F.when(k == 0, 0).otherwise(h["line"]), h["level"], F.lit(1), h["title"], h["number"]),
        ))
        deep = F.transform(heads, lambda h: _named(
            h["line"], h["level"], F.coalesce(h["outline"], h["level"]), h["title"], h["number"]))
        first = F.get(heads, F.lit(0))["line"]
        before = F.exists(F.slice(lines, 1, first), has_text)
        return (
            F.when(F.size(heads) == 0, F.when(F.exists(lines, has_text), whole)
                   .otherwise(F.slice(whole, 1, 0)))
            .when(F.exists(heads, lambda h: h["outline"].isNull() | (h["outline"] == 1)), by_top)
            .when(before, F.concat(preface, deep))
            .otherwise(deep)
        )

    return let(headings_of(lines), by_heads)


def is_body_line(line: Column) -> Column:
    """Neither blank nor a heading."""
    return has_text(line) & ~line.rlike(STRIPPED_HEADING)


def has_body(lines: Column) -> Column:
    """A body line exists; rare separators inside a line count as line breaks too."""
    return F.exists(lines, lambda x: F.when(
        x.rlike(RARE_BREAK), F.exists(split_lines(x), is_body_line)).otherwise(is_body_line(x)))


def _with_ends(starts: Column, total: Column) -> Column:
    """Add the line after the last one of each section."""
    return F.transform(starts, lambda s, k: s.withField(
        "stop", F.coalesce(F.get(starts, k + 1)["line"], total)))


def collapse_starts(lines: Column, starts: Column) -> Column:
    """A section without body takes the following ones, up to the first with body."""
    return let(_with_ends(starts, F.size(lines)), lambda ss: let(
        F.transform(ss, lambda s: has_body(span(lines, s["line"], s["stop"] - 1))),
        lambda bodies: let(
            F.filter(ss, lambda s, k: (k == 0) | F.get(bodies, k - 1)),
            lambda kept: _with_ends(kept, F.size(lines)),
        ),
    ))


def _block_rows(lines: Column, blocks: Column) -> Column:
    """Blocks with their text, character offsets and line spans."""
    total = F.size(lines)

    def with_text(b: Column) -> Column:
        text = F.array_join(span(lines, b["line"], b["stop"] - 1), "\n")
        return b.withField("raw", F.when(b["stop"] < total, F.concat(text, F.lit("\n"))).otherwise(text))

    def with_spans(bs: Column) -> Column:
        lengths = F.transform(bs, lambda b: F.length(b["raw"]))
        lead = F.coalesce(F.aggregate(
            F.slice(lines, 1, F.get(bs, F.lit(0))["line"]), F.lit(0), lambda n, x: n + F.length(x) + 1), F.lit(0))
        return let(F.struct(lengths.alias("ns"), lead.alias("lead")), lambda v: F.transform(bs, lambda b, k: let(
            v["lead"] + F.aggregate(F.slice(v["ns"], 1, k), F.lit(0), lambda a, n: a + n),
            lambda start: F.struct(
                (k + 1).alias("section_index"),
                b["header_level"].alias("header_level"),
                b["title_level"].alias("title_level"),
                b["number"].alias("section_number"),
                b["title"].alias("section_title"),
                # a span end is the line of the last character; a closing line break
                # already counts as part of the line after it
                F.array(
                    (b["line"] + 1 + F.when((F.get(lines, b["line"]) == "") & (b["line"] < total - 1), 1)
                     .otherwise(0)).cast("int"),
                    F.when(b["stop"] < total, b["stop"] + 1).otherwise(total).cast("int"),
                ).alias("line_span"),
                F.array(start.cast("int"), (start + F.get(v["ns"], k)).cast("int")).alias("char_span"),
                strip(b["raw"]).alias("content"),
            ),
        )))

    return let(F.transform(blocks, with_text), with_spans)


def split_sections(docs: DataFrame, run_id: str, collapse: bool = True) -> DataFrame:
    """Sections with spans and metrics, one row per block."""
    def blocks(lines: Column) -> Column:
        return let(split_starts(lines), lambda starts: _block_rows(
            lines, collapse_starts(lines, starts) if collapse else _with_ends(starts, F.size(lines))))

    exploded = docs.select(
        F.lit(run_id).alias("run_id"),
        *[c for c in ("doc_index", "doc_id", "file_name") if c in docs.columns],
        F.explode(let(F.split("content", "\n", -1), blocks)).alias("b"),
    )
    counts = let(split_lines(F.col("content")), lambda lines: F.struct(
        F.size(F.filter(lines, has_text)).alias("content_non_empty_lines"),
        F.size(F.filter(lines, is_body_line)).alias("effective_body_non_empty_lines")))
    return (
        exploded.select("*", "b.*").drop("b")
        .withColumn("chunk_index", F.col("section_index") - 1)
        .withColumn("block_id", F.format_string("b%04d", F.col("section_index")))
        .withColumn("outline_level", F.col("title_level"))
        .withColumn("content_char_len", F.length("content"))
        .withColumn("_counts", counts)
        .select("*", "_counts.*").drop("_counts")
    )


def section_metrics(sections: DataFrame) -> DataFrame:
    """The size columns of each section."""
    return sections.select("run_id", "doc_id", "chunk_index", "content_char_len", "content_non_empty_lines",
                           "effective_body_non_empty_lines")


def render_human_chunks(sections: DataFrame) -> DataFrame:
    """Readable text of each block: a header of metadata, then numbered lines."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    def pair(name: str) -> Column:
        return F.format_string("[%d, %d]", F.col(name)[0], F.col(name)[1])

    lines = split_lines(F.col("content"))
    first = F.col("line_span")[0]
    head = [
        ("source_file", shown("file_name")), ("doc_id", shown("doc_id")), ("chunk_index", shown("chunk_index")),
        ("block_id", shown("block_id")), ("section_number", shown("section_number")),
        ("header_level", shown("header_level")), ("outline_level", shown("outline_level")),
        ("title_level", shown("title_level")), ("section_title", shown("section_title")),
        ("line_span", pair("line_span")), ("char_span", pair("char_span")),
        ("line_count", F.size(lines).cast("string")),
        ("effective_body_non_empty_lines", shown("effective_body_non_empty_lines")),
    ]
    header = F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), v) for k, v in head])
    body = F.transform(lines, lambda x, i: F.concat((first + i).cast("string"), F.lit(": "), x))
    text = F.concat(
        header, F.lit("\n\nlines:\n--- chunk ("), F.col("block_id"), F.lit(": "), F.col("section_title"),
        F.lit(") ---\n"), F.array_join(body, "\n"), F.lit("\n"),
    )
    return sections.select("run_id", "doc_id", "chunk_index",
                           F.format_string("%s_%d.txt", "doc_id", "chunk_index").alias("chunk_file"),
                           text.alias("chunk_text"))


def write_human_chunks(chunks: DataFrame, path: str, mode: str = "errorifexists", folders: int = 256) -> None:
    """Text records of the blocks, a document's in order, in ``folders`` folders by the hash of its id.

    A record says itself which document it is of; a folder for each document would be
    millions of them.
    """
    folder = F.pmod(F.xxhash64("doc_id"), F.lit(folders))
    (chunks.withColumn("folder", folder).repartition(folders, "folder").sortWithinPartitions("folder", "doc_id", "chunk_index")
     .select("folder", F.col("chunk_text").alias("value"))
     .write.mode(mode).option("lineSep", "\n\f\n").partitionBy("folder").text(path))


# --- first-generation split: four heading levels, blocks named by their outermost heading

PATH_LEVELS = 4


def _fences(lines: Column) -> Column:
    """Closed line intervals of fenced code."""
    marks = F.array_compact(F.transform(lines, lambda x, i: F.when(
        x.startswith("```") | x.startswith("~~~"),
        F.struct(i.alias("line"), F.substring(x, 1, 3).alias("mark"),
                 (x.startswith("~~~") | (F.size(F.split(x, "```")) == 2)).alias("opens")),
    )))
    start = F.struct(F.lit("").alias("open"), F.lit(0).alias("since"),
                     F.array().cast("array<struct<s:int,e:int>>").alias("done"))

    def step(s: Column, m: Column) -> Column:
        closing = (s["open"] != "") & (m["mark"] == s["open"])
        opening = (s["open"] == "") & m["opens"]
        return F.struct(
            F.when(closing, "").when(opening, m["mark"]).otherwise(s["open"]).alias("open"),
            F.when(opening, m["line"]).otherwise(s["since"]).alias("since"),
            F.when(closing, F.concat(s["done"], F.array(F.struct(s["since"].alias("s"), m["line"].alias("e")))))
            .otherwise(s["done"]).alias("done"),
        )

    return F.aggregate(marks, start, step, lambda s: F.when(s["open"] == "", s["done"]).otherwise(
        F.concat(s["done"], F.array(F.struct(s["since"].alias("s"), F.size(lines).alias("e"))))))


def _header_paths(lines: Column, fences: Column) -> Column:
    """Blocks between headings: first line and the names of the headings above it."""
    heads = F.array_compact(F.transform(lines, lambda x, i: F.when(
        x.rlike(r"^#{1,4}(?: |\z)") & ~F.exists(fences, lambda f: (f["s"] <= i) & (i <= f["e"])),
        let(F.length(F.regexp_extract(x, "^(#+)", 1)), lambda n: F.struct(
            i.alias("line"), n.alias("level"), strip(F.regexp_replace(x, "^#+", "")).alias("title"))),
    )))
    names = "array<struct<level:int,title:string>>"
    state = F.struct(F.array().cast(names).alias("path"),
                     F.array().cast(f"array<struct<line:int,path:{names}>>").alias("done"))

    def step(s: Column, h: Column) -> Column:
        path = F.concat(F.filter(s["path"], lambda p: p["level"] < h["level"]),
                        F.array(F.struct(h["level"].alias("level"), h["title"].alias("title"))))
        return F.struct(path.alias("path"), F.concat(
            s["done"], F.array(F.struct(h["line"].alias("line"), path.alias("path")))).alias("done"))

    preface = F.array(F.struct(F.lit(0).alias("line"), F.array().cast(names).alias("path")))
    return F.concat(preface, F.aggregate(heads, state, step, lambda s: s["done"]))


def split_by_header_path(docs: DataFrame) -> DataFrame:
    """Blocks below H1-H4 headings, named by their outermost heading.

    A heading closes the deeper ones, fenced code opens none, text above all headings
    is left out. Neighbours with equal paths form one block, and a block that is only a
    heading joins the deeper block below it. Paragraphs are parted by a Markdown line
    break; a leading copy of the block's own title is removed.
    """
    def parts(lines: Column, fences: Column) -> Column:
        return let(_header_paths(lines, fences), lambda bs: let(
            F.filter(F.transform(bs, lambda b, k: F.struct(
                b["line"].alias("line"), b["path"].alias("path"),
                F.filter(span(lines, b["line"], F.coalesce(F.get(bs, k + 1)["line"], F.size(lines)) - 1),
                         lambda x: x != "").alias("text"))),
                lambda b: F.size(b["text"]) > 0),
            lambda full: let(
                F.transform(full, lambda b, k: let(F.get(full, k - 1), lambda prev: (k == 0) | ~F.coalesce(
                    (prev["path"] == b["path"])
                    | ((F.size(prev["path"]) < F.size(b["path"]))
                       & F.element_at(prev["text"], -1).startswith("#")), F.lit(False)))),
                lambda opens: let(
                    F.filter(F.transform(full, lambda b, k: F.struct(
                        k.alias("k"), b["line"].alias("line"), F.get(opens, k).alias("open"))), lambda b: b["open"]),
                    lambda kept: F.transform(kept, lambda g, j: let(
                        F.coalesce(F.get(kept, j + 1)["k"], F.size(full)),
                        lambda stop: F.struct(
                            F.get(F.get(full, stop - 1)["path"], F.lit(0)).alias("top"),
                            g["line"].alias("line"),
                            F.coalesce(F.get(full, stop)["line"], F.size(lines)).alias("stop"),
                        ))),
                ),
            ),
        ))

    def text_of(lines: Column, fences: Column, b: Column) -> Column:
        gap = "\x00"
        marked = F.transform(F.sequence(b["line"], b["stop"] - 1), lambda i: let(F.get(lines, i), lambda x: F.when(
            (x == "") & ~F.exists(fences, lambda f: (f["s"] <= i) & (i <= f["e"])), gap).otherwise(x)))
        joined = F.regexp_replace(F.array_join(marked, "\n"), "^(?:\x00\n?)+|(?:\n?\x00)+\\z", "")
        return strip(F.regexp_replace(joined, "(?:\n\x00)+\n", "  \n"))

    def blocks(raw: Column) -> Column:
        return let(F.transform(raw, strip), lambda lines: let(_fences(lines), lambda fences: F.transform(
            F.filter(parts(lines, fences), lambda b: b["top"].isNotNull()),
            lambda b: F.struct(b["top"]["level"].alias("level"), b["top"]["title"].alias("title"),
                               text_of(lines, fences, b).alias("text")),
        )))

    exploded = docs.select(
        *[c for c in docs.columns if c != "content"],
        F.posexplode(blocks(F.split("content", "\n", -1))).alias("chunk_index", "b"),
    )
    heading = F.concat(F.repeat(F.lit("#"), F.col("b.level")), F.lit(" "), F.col("b.title"))
    return exploded.select(
        *[c for c in docs.columns if c != "content"], "chunk_index",
        F.format_string("H%d", "b.level").alias("title_level"),
        F.col("b.title").alias("content_title"),
        strip(F.when(F.startswith("b.text", heading), F.expr("substring(b.text, b.level + length(b.title) + 2)"))
              .otherwise(F.col("b.text"))).alias("content"),
    )

"""Text helpers with the Unicode behaviour the extraction rules expect."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from scholion.functions.arrays import let

# The characters counted as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The separators that end a line.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"

RARE_BREAK = LINE_BREAK.removeprefix(r"\r\n|").replace(r"\n", "")

SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
NOT_SPACE = r"(?U)[^\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Text without white space at its ends; untouched text is passed on as it is."""
    def edge(x: Column, end: Column) -> Column:
        return F.lit(WHITESPACE).contains(end)

    return let(text, lambda x: F.when(
        edge(x, F.left(x, F.lit(1))) | edge(x, F.right(x, F.lit(1))), F.btrim(x, F.lit(WHITESPACE))).otherwise(x))


def collapse(text: Column) -> Column:
    """Trimmed text with every run of white space turned into one blank."""
    return F.regexp_replace(strip(text), SPACE_RUN, " ")


def clean(text: Column) -> Column:
    """Collapsed text, or null when nothing is left."""
    return F.nullif(collapse(text), F.lit(""))


def is_blank(text: Column) -> Column:
    return ~has_text(F.coalesce(text, F.lit("")))


def has_text(text: Column) -> Column:
    """Some character is not white space."""
    return text.rlike(NOT_SPACE)


def split_lines(text: Column) -> Column:
    """Lines without their separators; a trailing separator opens no further line."""
    return let(F.split(text, LINE_BREAK, -1), lambda parts: F.when(
        F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def alternation(patterns: list[str] | tuple[str, ...], flags: str = "iU") -> str:
    """One Java regex for 'any of these patterns'."""
    return f"(?{flags})" + "|".join(f"(?:{p})" for p in patterns)


def required_text(pattern: str) -> str:
    """The longest run of plain characters every match of a simple pattern contains, in lower case."""
    flat = re.sub(r"\((?:[^()]|\([^()]*\))*\)[?*+]*|\[[^\]]*\][?*+]*", "\0", pattern)
    flat = re.sub(r"\\[bBsSwWdD][?*+]*|\.[?*+]+", "\0", flat)
    flat = re.sub(r"\\?.[?*]", "\0", flat)
    flat = re.sub(r"\\(.)", r"\1", flat)
    if "|" in flat:
        return ""
    return max(re.split("\0", flat), key=len).lower()


def fold(text: Column) -> Column:
    """Lower case, with the one letter whose lower case differs from its case-free form."""
    return F.lower(F.translate(text, "ſ", "s"))


def has_required(text: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Cheap first test: the text holds plain characters some pattern cannot do without.

    Substring search is far cheaper than the regex and rejects most texts.
    """
    return let(fold(text), lambda low: holds_required(low, patterns))


def holds_required(low: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """``has_required`` for a text that is folded already."""
    needed = sorted({required_text(p) for p in patterns}, key=len)
    needed = [n for i, n in enumerate(needed) if not any(m in n for m in needed[:i])]
    if needed[0] == "":
        return F.lit(True)
    words = F.split(F.lit("\x1f".join(needed)), "\x1f")
    return F.exists(words, lambda n: low.contains(n))


def any_pattern(text: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Any pattern occurs, ignoring case."""
    if not patterns:
        return F.lit(False)
    return has_required(text, patterns) & text.rlike(alternation(patterns))


def any_phrase(text: Column, phrases: list[str] | tuple[str, ...]) -> Column:
    """Plain substring test for a fixed phrase list."""
    return text.rlike("|".join(re.escape(p) for p in phrases)) if phrases else F.lit(False)


def quote_regex(text: Column) -> Column:
    """Escape regex metacharacters of a text column."""
    return F.regexp_replace(text, r"([\\^$.|?*+()\[\]{}\-])", r"\\$1")

"""Main text of web pages by a style tree of each site.

The element trees of a host's pages are merged: elements of the same path of tags and classes are
one node. A node's importance is the mean of two entropies over the host's pages, each on a scale
from 0 to 1: that of its content (the text below it) and that of its presentation (the tags of its
children). What is the same on all pages of a site has low importance. Elements that by their tag,
role or class are page furniture have importance 0 from the start: a class or id counts if one of
its words is a name of furniture and the others are such names or their usual companions
(``comment-list``, ``site-footer``), and not where it wraps the page's article or most of its text.
Each page loses its branches of low importance; what is left of its article (or of its body, where
the articles are only teasers) is split into blocks. Where that would take the whole article, the
page repeats others, and only tags, roles and names count.

Whether a node is low depends on the pages that have it alone, not on the size of its host. Counts
are summed by content before they are shuffled, so the host that has a third of all pages is spread.
Pages with the same set of nodes share a layout, and low nodes are kept per layout: a list is never
longer than the nodes of one page.

Defined cases: null and empty pages give an empty text; pages with a null or odd url form one host;
nodes on fewer than ``MIN_PAGES`` pages are judged by tags, roles and classes only; unclosed, stray and broken tags are
mended as browsers do for blocks; repeated rows each get their text; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from scholion.llm.common import stored

#: A node is low if it is on so many pages of its host, at this importance or less.
MIN_PAGES, LOW = 3, 0.15
#: Articles with a smaller share of a page's text are teasers.
TEASER = 0.2
#: Counts that a task holds before it passes them on.
HELD = 50_000

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
# fixed values: names of HTML elements by how browsers treat them
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
ENDS_ALSO = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("article aside body div footer form header html li main nav ol section table td th tr ul dl blockquote".split())
FURNITURE = frozenset("aside button canvas dialog fieldset footer form head iframe input label menu nav noscript object option script select style "
                      "svg template textarea title".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NAMES = frozenset("ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
                  "login menu modal nav navbar navigation newsletter notice notification notifications overlay pager pagination popup promo "
                  "promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar "
                  "widget".split())
PAGE_NAMES = frozenset("header masthead topbar".split())
# fixed values: words that often stand beside a name of furniture, and those beside a name of PAGE_NAMES
COMPANIONS = frozenset("area article bar block blog body bottom box button buttons center col column container content count desktop entry fixed "
                       "floating form global group holder icon icons inline inner item items left link links list main meta mobile outer page panel "
                       "post posts primary right secondary section site slot sticky text thread title top unit user users wrap wrapper".split())
PAGE_COMPANIONS = frozenset("bar global main mobile site sticky top".split())
WHOLE = frozenset("html body main article".split())
#: Blocks of a link only stay here; elsewhere they are entries of a menu.
TEXT_BLOCKS = frozenset("blockquote dd figcaption h1 h2 h3 h4 h5 h6 p".split())


def _code(data: bytes, seed: int) -> int:
    """63 bits that depend on the data and on the code before it."""
    return xxh3_64_intdigest(data, seed) >> 1


def _furniture_name(name: str, within: str) -> bool:
    parts = [p for p in re.split(r"[^a-z0-9]+", name) if p and not p[0].isdigit()]
    if any(p in NAMES for p in parts):
        return all(p in NAMES or p in COMPANIONS or p in PAGE_NAMES for p in parts)
    return not within and any(p in PAGE_NAMES for p in parts) and all(p in PAGE_NAMES or p in PAGE_COMPANIONS for p in parts)


class Page:
    """Elements of a page with their parents and paths, and its text in order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.paths, self.furniture, self.within = ["#"], [0], [0], [False], [""]
        self.named = [False]
        #: (element, text), or (element, None) where a block begins or ends
        self.items: list[tuple[int, str | None]] = []
        self._read(source)

    def _open(self, parent: int, tag: str, attributes: str) -> int:
        names, role, hidden = "", "", False
        if attributes and "=" in attributes or "hidden" in attributes:
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), (a or b or c).lower()
                if name in ("class", "id"):
                    names += " " + value
                elif name == "role":
                    role = value
                elif name == "hidden" or value == "true":
                    hidden = True
        within = self.within[parent]
        if tag in ("article", "main") and within != "article":
            within = tag
        self.tags.append(tag)
        self.parents.append(parent)
        self.within.append(within)
        self.paths.append(_code(f"{tag} {re.sub('[0-9]+', '0', names)}".encode("utf-8", "replace"), self.paths[parent]))
        self.furniture.append(hidden or tag in FURNITURE or role in ROLES or tag == "header" and not within
                              or bool(names) and tag in WHOLE and self._named(tag, names, within))
        self.named.append(bool(names) and tag not in WHOLE and self._named(tag, names, within))
        return len(self.tags) - 1

    @staticmethod
    def _named(tag: str, names: str, within: str) -> bool:
        whole = names.split()
        if tag in WHOLE:
            return any(n in ("comment", "comments") for n in whole)
        return any(_furniture_name(n, within) for n in whole)

    def _read(self, source: str) -> None:
        stack, at, n, items = [0], 0, len(source), self.items
        while at < n:
            found = TOKEN.search(source, at)
            if found is None:
                items.append((stack[-1], source[at:]))
                break
            if found.start() > at:
                items.append((stack[-1], source[at:found.start()]))
            at = found.end()
            closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if closing:
                self._close(stack, tag)
                continue
            if tag in BLOCKS and tag != "hr":
                self._end(stack, ("p",))
            if tag in ENDS_ALSO:
                self._end(stack, ENDS_ALSO[tag])
            if tag in ("br", "td", "th"):
                items.append((stack[-1], " "))
            if tag in VOID:
                if tag == "hr":
                    items.append((stack[-1], None))
                continue
            node = self._open(stack[-1], tag, attributes)
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(source, at)
                at = end.end() if end else n
                continue
            if attributes.endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "em", "strong", "span"):
                continue
            if tag in BLOCKS:
                items.append((node, None))
            stack.append(node)

    def _close(self, stack: list[int], tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if self.tags[stack[k]] == tag:
                for node in reversed(stack[k:]):
                    if self.tags[node] in BLOCKS:
                        self.items.append((self.parents[node], None))
                del stack[k:]
                return
            if self.tags[stack[k]] in SCOPE and tag not in SCOPE:
                return

    def _end(self, stack: list[int], tags: tuple[str, ...]) -> None:
        """Close an open element of these tags that is not beyond a container."""
        for k in range(len(stack) - 1, 0, -1):
            if self.tags[stack[k]] in tags:
                del stack[k:]
                self.items.append((stack[-1], None))
                return
            if self.tags[stack[k]] in SCOPE:
                return

    def nodes(self) -> dict[int, tuple[int, int]]:
        """For each path with text below it: checksums of that text and of the tags of the children."""
        content, children = [0] * len(self.tags), [0] * len(self.tags)
        for node, text in self.items:
            if text is not None and (plain := text.strip()):
                content[node] = _code(plain.encode("utf-8", "replace"), content[node])
        for node in range(len(self.tags) - 1, 0, -1):
            parent = self.parents[node]
            if content[node]:
                content[parent] = _code(content[node].to_bytes(8, "little"), content[parent])
            children[parent] = _code(self.tags[node].encode("utf-8", "replace"), children[parent])
        of: dict[int, tuple[int, int]] = {}
        for node in range(1, len(self.tags)):
            if content[node]:
                a, b = of.get(self.paths[node], (0, 0))
                of[self.paths[node]] = (_code(content[node].to_bytes(8, "little"), a), _code(children[node].to_bytes(8, "little"), b))
        return of

    def _below(self, cut: list[bool]) -> list[bool]:
        gone = [False] * len(self.tags)
        for node in range(1, len(self.tags)):
            gone[node] = gone[self.parents[node]] or cut[node]
        return gone

    def _apart(self, cut: list[bool], gone: list[bool], rank: dict[str, int]) -> list[bool]:
        """The elements with a name of furniture, but for those that wrap the article or most of the distinct text."""
        reach, letters, inner, seen = 0, [0] * len(self.tags), [0] * len(self.tags), set()
        for node, text in self.items:
            if text is not None and not cut[node] and (plain := text.strip()):
                if not gone[node]:
                    reach = max(reach, rank[self.within[node]])
                letters[node] += len(plain) * (plain not in seen)
                seen.add(plain)
        for node in range(len(self.tags) - 1, 0, -1):
            parent = self.parents[node]
            letters[parent] += letters[node]
            inner[parent] = max(inner[parent], inner[node], 0 if cut[node] else rank.get(self.tags[node], 0))
        most = [2 * n > letters[0] for n in letters]
        return [named and not ((inner[k] or most[k]) if not reach else inner[k] > reach and most[k] and rank[self.within[k]]) for k, named in enumerate(self.named)]

    def text(self, low: frozenset[int]) -> str:
        rank = {"article": 2, "main": 1, "": 0}
        gone = self._gone(low, rank)
        letters = self._letters(gone, rank)
        if low:
            plain = self._gone(frozenset(), rank)
            before = self._letters(plain, rank)
            if max(before, default=0) > max(letters, default=-1) or not letters:
                gone, letters = plain, before
        best = max((r for r in letters if sum(n for s, n in letters.items() if s >= r) >= TEASER * sum(letters.values())), default=0)
        linked, block = [False] * len(self.tags), [""] * len(self.tags)
        for node in range(1, len(self.tags)):
            linked[node] = linked[self.parents[node]] or self.tags[node] == "a"
            block[node] = self.tags[node] if self.tags[node] in BLOCKS else block[self.parents[node]]
        blocks, held, links, size, within = [], [], 0, 0, ""

        def flush() -> None:
            nonlocal held, links, size
            if size and (best or links < size or within in TEXT_BLOCKS):
                blocks.append(" ".join("".join(held).split()))
            held, links, size = [], 0, 0

        for node, text in self.items:
            if text is None:
                flush()
            elif not gone[node] and rank[self.within[node]] >= best:
                plain = entities.unescape(text)
                held.append(plain)
                own = len(plain.strip())
                within = block[node] if own else within
                size += own
                links += own * linked[node]
        flush()
        return "\n\n".join(b for b in blocks if b)

    def _letters(self, gone: list[bool], rank: dict[str, int]) -> dict[int, int]:
        """How much text is left outside (0), in main (1) and in an article (2)."""
        of: dict[int, int] = {}
        for node, text in self.items:
            if text is not None and not gone[node] and (size := len(text.strip())):
                r = rank[self.within[node]]
                of[r] = of.get(r, 0) + size
        return of

    def _gone(self, low: frozenset[int], rank: dict[str, int]) -> list[bool]:
        cut = [self.furniture[node] or (self.paths[node] in low and self.tags[node] not in WHOLE) for node in range(len(self.tags))]
        gone = self._below([c or n for c, n in zip(cut, self.named)])
        if any(self.named):
            gone = self._below([c or n for c, n in zip(cut, self._apart(self._below(cut), gone, rank))])
        return gone


def layout(paths: list[int]) -> int:
    """Code of a page's set of paths; 0 where there are none."""
    return _code(b"".join(p.to_bytes(8, "little") for p in sorted(paths)), 0) if paths else 0


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _counted(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Counts (host, path, kind, code, n) of contents (kind 0), presentations (1) and layouts (2) of the nodes."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed() -> pa.RecordBatch:
            keys = list(zip(*held)) or [(), (), (), ()]
            batch = pa.RecordBatch.from_arrays([pa.array(keys[0], pa.string()), pa.array(keys[1], pa.int64()), pa.array(keys[2], pa.int32()),
                                                pa.array(keys[3], pa.int64()), pa.array(list(held.values()), pa.int64())], ["host", "path", "kind", "code", "n"])
            held.clear()
            return batch

        for batch in batches:
            for host, source in zip(*(c.to_pylist() for c in batch.columns)):
                nodes = Page(source).nodes()
                own = layout(list(nodes))
                for path, (content, children) in nodes.items():
                    held[(host, path, 0, content)] += 1
                    held[(host, path, 1, children)] += 1
                    held[(host, path, 2, own)] += 1
                if len(held) > HELD:
                    yield passed()
        yield passed()

    each = rows.mapInArrow(counts, "host string, path bigint, kind int, code bigint, n bigint")
    return stored(each.groupBy("host", "path", "kind", "code").agg(F.sum("n").alias("n")))


def _tree(summed: DataFrame) -> DataFrame:
    spread = summed.where(F.col("kind") < 2).groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")).otherwise(1.0)
    return spread.groupBy("host", "path").agg(F.max("m").alias("pages"), F.avg(entropy).alias("importance"))


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host and path: host, path, pages (with text there), importance."""
    return _tree(_counted(pages, url, html))


def low_nodes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, layout, low): the paths of the low nodes of each layout of a host, at most the nodes of a page."""
    summed = _counted(pages, url, html)
    low = _tree(summed).where((F.col("importance") <= LOW) & (F.col("pages") >= MIN_PAGES)).select("host", "path")
    used = summed.where(F.col("kind") == 2).select("host", "path", F.col("code").alias("layout"))
    return used.join(low, ["host", "path"]).groupBy("host", "layout").agg(F.collect_list("path").alias("low"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: key, url, text."""
    low = stored(low_nodes(pages, url, html))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    kind = rows.schema["key"].dataType.simpleString()

    @F.pandas_udf("bigint")
    def layouts(htmls: pd.Series) -> pd.Series:
        return pd.Series([layout(list(Page(x or "").nodes())) for x in htmls], dtype="int64")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Page(x or "").text(frozenset(low or ())) for x, low in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["key", "url", "text"])

    return rows.withColumn("layout", layouts("html")).join(low, ["host", "layout"], "left").select("key", "url", "html", "low").mapInArrow(
        texts, f"key {kind}, url string, text string").withColumnRenamed("key", key)

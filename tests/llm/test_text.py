"""Encoding, edit-aware counts and page text, against brute force."""

import base64
import hashlib
import html
import random
import re

import numpy as np
import pytest
import tiktoken

from scholion.llm import bpe, html_extract, queries, token_counts
from scholion.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.fixture(scope="module")
def words():
    return bpe.vocabulary(queries.RANKS, queries.PATTERN)


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


@pytest.mark.parametrize("chunk,overlap", [(32_768, 256), (500, 40), (37, 5)])
def test_encoding_is_that_of_the_library(spark, odd, library, chunk, overlap):
    for docs in (odd.where("doc_id IS NULL OR doc_id <> 5 OR " + str(chunk > 100).lower()), table(spark, SF, "documents").where("length(text) < 9000")):
        got = bpe.encode(docs, queries.RANKS, queries.PATTERN, chunk=chunk, overlap=overlap).collect()
        want = [(r["doc_id"], library(r["text"] or "")) for r in docs.collect()]
        assert sorted(((r["doc_id"], numbers(r["ids"])) for r in got), key=repr) == sorted(want, key=repr)
        assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in got)


def test_registered_encoding_round_trip(spark, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for r in queries.op8_byte_bpe(spark, SF).collect():
        ids = np.array(library(texts[r["doc_id"]]), "<u4").tobytes()
        assert r["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_stitching_where_a_word_covers_the_overlap(words, library):
    text = "aa " + "b" * 400 + "   \n\n  " + "7" * 300 + " it's   " + "é😀" * 90
    for chunk, overlap in ((50, 10), (64, 3), (11, 11)):
        starts = range(0, len(text), chunk)
        runs = [bpe.Run.of(words, text[max(0, s - overlap):s + chunk + overlap], max(0, s - overlap)) for s in starts]
        assert numbers(bpe.stitch(words, runs)) == library(text)


def test_empty_tables_and_null_ids(spark, nothing):
    assert bpe.encode(nothing, queries.RANKS, queries.PATTERN).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert bpe.decode(null, queries.RANKS, queries.PATTERN).first()["decoded"] is None


def test_counts_follow_random_edits(words, library):
    rng = random.Random(5)
    pieces = [" ", "  ", "\n", "\n\n ", "word", "it's", "é", "😀", "12", "!?", "a", " b", "\t", "'ll"]
    for _ in range(60):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 700)))
        tree = token_counts.TokenTree(words, text)
        for _ in range(25):
            at, removed = rng.randrange(0, len(text) + 2), rng.choice([0, 1, 2, 5, 40, 1000])
            added = "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 2, 30])))
            tree.edit(at, removed, added)
            at = min(at, len(text))
            text = text[:at] + added + text[at + removed:]
            assert tree.n_chars == len(text) and tree.n_tokens == len(library(text))
            assert "".join(x for leaf in tree.leaves for x in leaf) == text


def test_edits_touch_little(spark):
    rows = queries.op1_token_counts(spark, SF).collect()
    assert sum(r["n_encoded"] for r in rows) < 0.2 * sum(r["n_pretokens"] for r in rows)


def test_counts_of_odd_rows(spark, odd, nothing):
    edits = spark.createDataFrame([(1, 1, 0, 5, "X"), (1, 0, 2, 0, None), (2, 0, -3, None, "new text"), (3, 0, 9, 9, "é"), (5, 0, 70_010, 2, " ")],
                                  "doc_id bigint, seq int, at bigint, removed bigint, inserted string")
    got = token_counts.count(token_counts.with_edits(odd, edits), queries.RANKS, queries.PATTERN).collect()
    assert len(got) == odd.count()
    two = next(r for r in got if r["doc_id"] == 2)
    assert (two["tokens_before"], two["tokens_after"], two["chars_after"]) == (0, 2, 8)
    assert token_counts.count(nothing.withColumn("edits", queries.sample_edits()), queries.RANKS, queries.PATTERN).count() == 0


def test_page_text_is_the_article(spark):
    pages = table(spark, SF, "pages")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


PAGE = """<html><body class=home><header><h1>Site</h1></header><div class="side-bar sidebar">side</div><div id=content><h1>Title</h1>
<p>One &amp; two<p>Three <b>bo</b>ld<br>x<ul><li>four<li>five</ul><blockquote>six<div id="comments"><p>reader</p></div></blockquote>
<form>go <input></form><script>if (a < b) { "</p>" }</script></div><p>Same line on every page of the site</p>
<div class="cookie-notice">we use</div><ul><li><a href=x>a b</a></li><li><a>c</a></li></ul><footer>end</footer></body></html>"""


def test_furniture_goes_without_an_article(spark):
    text = html_extract.Page(PAGE).text(frozenset())
    assert text == "Title\n\nOne & two\n\nThree bold x\n\nfour\n\nfive\n\nsix\n\nSame line on every page of the site"


@pytest.mark.parametrize("names", ['class="content has-sidebar"', 'class="no-sidebar"', 'id="page-with-navigation"', 'class="widget-area main-text"',
                                   'class="login-required article-body"', 'class="widget"'])
def test_wrappers_with_names_of_furniture_stay(names):
    text = lambda body: html_extract.Page(f"<body>{body}<div class='sidebar'>side</div><div class='cookie-notice'>we use</div></body>").text(frozenset())
    assert text(f"<div {names}><article><p>The text of the page</p></article></div>") == "The text of the page"
    assert text(f"<div {names}><p>The text of a page without an article</p></div>") == "The text of a page without an article"
    assert text("<main><p>Text</p></main><div class=related><article>Other, much longer than this page</article></div>") == "Text"


def test_references_that_are_mostly_links_stay():
    page = "<body><p>Text</p><ul><li>[1] <a href=x>A long title of a paper</a></li></ul></body>"
    assert html_extract.Page(page).text(frozenset()) == "Text\n\n[1] A long title of a paper"


def test_what_a_site_repeats_goes(spark):
    made = [(i, f"https://one.example/p{i}", f"<body><div><p>Own text number {i} {i * 7}</p><section><b>Read our house rules</b></section></div></body>") for i in range(30)]
    made.append((99, "https://two.example/", "<body><div><p>Alone</p><section><b>Read our house rules</b></section></div></body>"))
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(made, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "Own text number 3 21" and got[99] == "Alone\n\nRead our house rules"


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "::", ""), (2, "http://x", "<p"), (2, "http://x", "<p"), (3, "u", "a < b &amp;&nbsp;c <!-- open"), (4, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "url AS host", "html AS text", "url AS low", "page_id AS key")
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in html_extract.extract(df).collect()), key=repr)
    assert got == sorted([(1, None, ""), (None, "::", ""), (2, "http://x", ""), (2, "http://x", ""), (3, "u", "a < b & c"), (4, "u", "deep")], key=repr)
    assert html_extract.extract(df.where("false")).count() == 0


@pytest.mark.parametrize("name", "comment-list comment-body user-comments comments-area post-comments site-footer main-nav menu-main ad-slot social-links "
                                 "share-buttons sidebar-right widget-area newsletter-box comment-1234 ad-728x90 site-header sidebar__inner".split())
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>"])
def test_compound_names_of_furniture_go(name, wrap):
    if name == "site-header" and "article" in wrap:
        return
    for attribute in ("class", "id"):
        body = wrap.format(f"<h1>Title</h1><p>The text of the page, longer than the rest.</p><div {attribute}='{name}'><p>Said by others</p></div>")
        assert html_extract.Page(f"<body>{body}</body>").text(frozenset()) == "Title\n\nThe text of the page, longer than the rest."


@pytest.mark.parametrize("name", ["comment-list", "main-nav", "sidebar-content", "post-menu-wrap", "ad-free-reading", "social-science", "commentary"])
def test_compound_names_around_the_article_stay(name):
    text = lambda body: html_extract.Page(f"<body>{body}<div class='sidebar'>side</div></body>").text(frozenset())
    assert text(f"<div class='{name}'><article><p>The text</p></article></div>") == "The text"
    assert text(f"<div class='{name}'><p>The text of a page without an article</p></div>") == "The text of a page without an article"


def test_links_and_teasers_outside_articles():
    text = lambda body: html_extract.Page(f"<body>{body}</body>").text(frozenset())
    assert text("<p>One</p><p><a href=x>Only a link</a></p><ul><li><a href=y>Menu</a></li></ul>") == "One\n\nOnly a link"
    long = "The whole text of this page, which is much longer than its teaser. " * 5
    assert text(f"<div><p>{long}</p></div><article><p>A teaser</p></article>") == f"{long.strip()}\n\nA teaser"
    assert text(f"<article><p>{long}</p></article><div>Loose line</div>") == long.strip()


def _site(host, n, notice="<section><b>Read our house rules</b></section>", own="Own text number {0} of {1}"):
    return [(None, f"https://{host}/p{i}", f"<body><div><p>{own.format(i, host)}</p>{notice}</div></body>") for i in range(n)]


def test_low_nodes_do_not_depend_on_the_size_of_the_host(spark):
    rows = _site("alone", 30) + _site("small", 5) + _site("large", 30) + _site("large", 400, "<em>Number {0}</em>".format("x"), "Other text {0} of {1}")
    got = {(r["url"], r["text"]) for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert not [t for _, t in got if "house rules" in t]
    assert ("https://large/p3", "Own text number 3 of large") in got and ("https://small/p3", "Own text number 3 of small") in got


def test_copies_of_a_page_keep_their_text(spark):
    rows = _site("copies", 40, own="The same text on every page") + [(None, "https://copies/x", "<body><div><p>Another</p></div></body>")]
    got = {r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {"The same text on every page\n\nRead our house rules", "Another"}


def test_lists_of_low_nodes_are_no_longer_than_a_page(spark):
    rows = [(None, f"https://one/p{i}", f"<body><div class=t{chr(97 + i // 5 % 20)}><p>Own {i}</p><b>Fixed {i // 5 % 20}</b></div></body>") for i in range(100)]
    low = html_extract.low_nodes(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert len(low) == 20 and all(len(r["low"]) <= 5 for r in low)

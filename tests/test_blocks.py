"""The block tokenizer: nothing readable is lost, odd make-up, bounded cost."""

import re
import time

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlweave.functions import blocks as B
from crawlweave.functions import markdown as M

TAGS = ["p", "div", "li", "ul", "ol", "td", "tr", "table", "th", "h2", "b", "i", "a", "code", "span", "blockquote",
        "section", "article", "br", "pre", "dl", "dd", "body", "html", "main", "tbody"]


@st.composite
def soup(draw):
    """Start and end tags in any order with numbered words between them."""
    out, words = [], 0
    for kind in draw(st.lists(st.sampled_from(["word", "word", "start", "end", "junk"]), max_size=60)):
        if kind == "word":
            words += 1
            out.append(f" w{words}x ")
        elif kind == "junk":
            out.append(draw(st.sampled_from(["< ", "&amp;", "&nope;", "\n", "<!-- c -->", "<3", "\t", "&"])))
        else:
            out.append(f"<{'/' if kind == 'end' else ''}{draw(st.sampled_from(TAGS))}>")
    return "".join(out), words


@settings(max_examples=400, deadline=None)
@given(soup())
def test_no_word_is_lost_repeated_or_moved(case):
    html, words = case
    blocks, _ = B.read(html)
    found = re.findall(r"w(\d+)x", "\n".join(b.markdown for b in blocks))
    assert found == [str(i + 1) for i in range(words)]
    kept = re.findall(r"w(\d+)x", B.markdown_of(html) or "")
    assert kept == sorted(set(kept), key=int)
    for b in blocks:
        assert 0 <= b.link_chars <= b.text_chars and b.depth <= B.MAX_DEPTH


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["<p>w", "</p>", "x &lt; y", "<b>", "</b>", "\n", "<br>", "  "]), max_size=30))
def test_without_articles_or_links_all_text_stays(parts):
    html = "".join(parts)
    words = re.findall("[wx<y]", re.sub("&lt;", "<", re.sub("<[^>]*>", " ", html)))
    assert re.findall("[wx<y]", (B.markdown_of(html) or "").replace("*", "")) == words


def test_structure():
    blocks, head = B.page_of("<html><head><title>T &amp; t</title><meta content=me name=Author></head><body>"
                             "<nav><a href=/>home</a></nav><div><h2>H</h2><p>one <a href='/u'>two</a></p></div></body>")
    assert head == {"title": "T & t", "author": "me"}
    assert [(b.tag, b.depth, b.text_chars, b.link_chars, b.kept) for b in blocks] == [
        ("nav", 3, 4, 4, False), ("h2", 4, 1, 0, True), ("p", 4, 7, 3, True)]
    assert [b.markdown for b in blocks][1:] == ["## H", "one [two](/u)"]


def test_boilerplate_ends_where_it_is_closed():
    def text(html):
        return B.markdown_of(html)

    assert text("<div><aside>no<div>no</div></div><p>yes") == "yes"
    assert text("<aside>yes<p>and yes") == "yes\n\nand yes"
    assert text("<body><footer>no</footer></body>after") == "after"
    assert text("<nav>only</nav>") is None
    assert text("<div class=\"bad ADS\">no<ul><li>no</ul></div><div class=address>yes</div>") == "yes"


def test_neighbours_decide_on_short_blocks():
    long = "word " * 30
    menu = "<p><a href=/a>link a</a></p><p>x</p><p><a href=/b>link b</a></p>"
    assert B.markdown_of(f"{menu}<h2>Head</h2><p>{long}</p><p>short</p>{menu}") == (
        f"## Head\n\n{long.strip()}\n\nshort")
    assert B.markdown_of("<a href=/a>only</a><p><a href=/b>links</a>") == "[only](/a)\n\n[links](/b)"


def test_ends_of_the_page():
    assert B.markdown_of("a<!-- not closed") == "a"
    assert B.markdown_of("a <b and c") == "a <b and c"
    assert B.markdown_of("a<script>b") == "a"
    assert B.markdown_of("a<svg>b") == "ab"


def test_layout_and_nested_tables():
    assert B.markdown_of("<table><tr><td>a<td><table><tr><td>b<td>c</table></table>") == "a\n\n| b | c |"
    assert B.markdown_of("<table><tr><td><p>a</p><td></tr><tr><td>b<br>c<td>d</table>") == "| a |  |\n| b c | d |"
    assert B.markdown_of("<table><tr><td>a</div><td>b</table></div>c") == "| a | b |\n\nc"


def test_cost_is_bounded():
    """Deep nesting, tags without an end, quotes without an end: linear, whatever the page."""
    n = 20_000
    pages = ["<div>" * n + "x", "<ul><li>" * n + "x", "<a title=\"" * n + "x", "<b><i>" * n + "x", "<svg>" * n + "x",
             "<" * n + "x", "<table><tr><td>" * n + "x", "<p>x</div>" * n, "<!--" * n, "&amp;" * n, "<pre>" * n + "x"]
    start = time.time()
    for page in pages:
        B.markdown_of(page)
    assert time.time() - start < 30
    assert B.markdown_of("<div>" * n + "x") == "x"


def test_rows_and_batches(spark):
    """Null and empty pages, extra columns, and worker batches bounded by bytes."""
    pages = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "<br>", "c"), (4, "<p>t", "d")],
                                  "id int, html string, kept string")
    out = {r.id: r.markdown for r in M.with_markdown(pages).collect()}
    assert out == {1: None, 2: None, 3: None, 4: "t"}
    assert M.with_markdown(pages).columns == ["id", "html", "kept", "markdown"]
    rows = M.page_blocks(pages, keep=["id"]).collect()
    assert [(r.id, r.block, r.tag, r.kept, r.markdown) for r in rows] == [(4, 1, "p", True, "t")]
    assert M.page_blocks(pages.limit(0), keep=["id"]).collect() == []

    def batch_bytes(x: pa.Array) -> pa.Array:
        return pa.array([x.nbytes] * len(x), pa.int64())

    many = spark.range(60).select(F.concat(F.lit("<p>"), F.repeat(F.lit("y"), 2_000_000)).alias("html")).coalesce(1)
    held = many.select(F.arrow_udf(batch_bytes, "long")("html").alias("n"))
    assert held.select(F.max("n").alias("n")).first().n < 40_000_000
    assert many.select(F.max(F.length(M.markdown(F.col("html")))).alias("n")).first().n == 2_000_000

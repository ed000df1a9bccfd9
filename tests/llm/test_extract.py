import html
import re

import pytest

from tests.llm.helpers import SF_DIR
from tierlake.llm import extract
from tierlake.llm.queries import QUERIES

PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body>
<nav><a href="/">Home</a></nav><div class="ad">Buy this great new thing now or never again.</div>
<article><h1>The&nbsp;title &amp; more</h1><p>First   paragraph with<br>some words in it.<p title="a>b">Second &lt;one&gt; &#233;.
<!-- not > this --><form><p>Your name please, we will not tell.</p></form><p hidden>Unseen</p><p>Third</p></article>
<section class="commentList"><p>A reader wrote this comment after reading it all.</p></section>
<footer>&copy; nobody</footer></body></html>"""


def test_main_text():
    assert extract.main_text(PAGE) == (
        "The title & more\nFirst paragraph with some words in it.\nSecond <one> é.\nThird")


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- never closed <p>text", "<script>never closed", "</p></div>", "<a b='"])
def test_nothing_to_find(page):
    assert extract.main_text(page) == ""


def test_cut_off_page():
    cut = PAGE[:PAGE.index("Third")] + "Third and la"
    assert extract.main_text(cut).endswith("\nThird and la")
    assert extract.main_text("<article><p>Some text &am").endswith("&am")


def test_long_page():
    page = "<article>" + "<p>word after word after word</p>" * 20_000 + "</article>"
    assert extract.main_text(page).count("\n") == 19_999


def plain_article(page):
    """The article of the given pages, which are all made alike."""
    found = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page, re.S)[1]
    found = re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\n", found))
    lines = [" ".join(html.unescape(line).split()) for line in re.sub(r"</?b>", "", found).split("\n")]
    return "\n".join(filter(None, lines))


def test_query_equals_the_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = QUERIES["op2_html_extract"](spark, SF_DIR).collect()
    assert len(rows) == len(pages)
    for r in rows:
        text = plain_article(pages[r["page_id"]]["html"])
        assert (r["url"], r["text"], r["n_chars"]) == (pages[r["page_id"]]["url"], text, len(text))


def test_tree_holds_on_labelled_pages():
    rows, labels = extract.labelled_table()
    assert (extract.decide(extract.trained(), rows) == (labels > 0)).mean() > 0.97


def test_edges(spark):
    rows = [(1, "u", PAGE, "x", 1), (1, "u", PAGE, "x", 1), (None, None, None, None, None), (2, "v", "", "y", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in extract.extract(pages).collect()]
    text = extract.main_text(PAGE)
    assert sorted(got, key=str) == sorted(
        [(1, "u", text, len(text))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract.extract(pages.limit(0)).count() == 0

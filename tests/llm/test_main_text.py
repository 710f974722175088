"""Main text of pages: whole cases, odd rows and the labelled table."""

import re
from html import unescape

import pyarrow.parquet as pq
import pytest

from tessera.llm import main_text as M

P = "This paragraph has quite a number of words, so that its length alone tells that it is text to read."
CASES = {
    "article with everything around": (
        f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head>
        <body class="has-sidebar"><header><h1>Site</h1><p>Slogan of the site</p></header><nav><ul><li><a href=/>Home</a>
        <li><a href=/n>News</a></ul></nav><!-- <p>gone</p> --><div class="ad">Buy this, it is very cheap today.</div>
        <article><header><h1>Title &amp; more</h1><p class=byline>By somebody</p></header><p>One.</p><p>{P}</p>
        <p><a href=x>Only a link</a></p><aside><p>{P}</p></aside><p class="cookie-notice">{P}</p>
        <ul><li>first<li>second <b>bold</b></ul><form><label>Mail</label><input value="x > y"></form>
        <table><tr><td>a<td>b</table><p>Two&nbsp;words
          and  more<br>here</p><noscript>no</noscript><svg><text>no</text></svg><div hidden>no</div></article>
        <section id="comments"><article><p>{P}</p></article></section><aside><p>{P}</p></aside>
        <footer><p>{P}</p>&copy; us</footer></body></html>""",
        ["Title & more", "One.", P, "Only a link", "first", "second bold", "a", "b", "Two words and more here"]),
    "named containers": (
        f"""<div id="wrapper"><div id="header"><a href=/>Site</a></div><div class="menu"><a>Home</a> <a>News</a></div>
        <div id="content"><h1>Title</h1><p>{P}</p><p>Short.</p><div class="share"><a>Share</a></div></div>
        <div id="sidebar"><p>{P}</p></div><div id="footer">Copyright by us</div></div>""", ["Title", P, "Short."]),
    "no containers": (
        f"""<ul><li><a href=1>Home</a><li><a href=2>About us</a></ul><p>{P}<p>{P} <a href=3>see</a> {P}<p>{P}
        <p><a href=x>Previous page</a> <a href=y>Next page</a>""", [P, f"{P} see {P}", P]),
    "cut off in a tag": (f"<body><article><p>{P}</p><p>rest &am", [P, "rest &am"]),
    "cut off in an attribute": (f'<article><p>{P}</p><p>end<a href="x', [P, "end"]),
    "cut off reference": (f"<article><p>{P}</p><p>a &amp", [P, "a &"]),
    "unclosed elements": ("<article><p>a<p class=ad>Buy<p>b <b>c<div>d</div>e", ["a", "b c", "d", "e"]),
    "signs that are no tags": ("<main><p>1 < 2 and a<3, x<y></p><p title='a > b'>q</p></main>", ["1 < 2 and a<3, x", "q"]),
    "upper case": ("<BODY><NAV><A>x</A></NAV><ARTICLE><P>Y</P><SCRIPT>z</SCRIPT></ARTICLE>", ["Y"]),
    "nothing to read": ("<nav><a>Home</a></nav><footer>x</footer>", []),
    "white space only": (" \n\t", []),
    "empty": ("", []),
    "null": (None, []),
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k, name, page, "clash", 1) for k, (name, (page, _)) in enumerate(CASES.items())]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    return {r["url"]: r for r in M.extract_text(pages).collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(texts, name):
    assert texts[name]["text"].split("\n") == (CASES[name][1] or [""])
    assert texts[name]["n_chars"] == len("\n".join(CASES[name][1]))


def test_odd_rows(spark):
    schema = "page_id long, url string, html string"
    long = f"<article><p>{'word ' * 300_000}</p>" + "<p>x</p>" * 20_000
    rows = [(None, None, "<article>a"), (None, None, "<article>a"), (1, None, long), (2, "u", None)]
    got = M.extract_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 1), (0, 1), (1, 1_499_999 + 40_000), (2, 0)]
    assert M.extract_text(spark.createDataFrame([], schema)).count() == 0
    assert M.text_blocks(spark.createDataFrame([], schema)).count() == 0


def test_quotes_without_end_take_no_time():
    assert M.blocks_of("<article>" + "<a \"" * 20_000 + "<p '" * 20_000) == []


def test_labelled_table_is_learned():
    x, y = M.training_table()
    tree = M.trained_tree()
    right = sum((M.predict(tree, tuple(row)) > 0.5) == label for row, label in zip(x.tolist(), y))
    assert x.shape[1] == len(M.FEATURES) and right / len(y) > 0.99
    assert tree == M.fit_tree(x, y)


def test_blocks_carry_their_neighbours(spark):
    page = "<nav><a>Home page</a></nav><article><h1>A title</h1><p>one two <a>three</a></p></article>"
    got = M.text_blocks(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string"))
    rows = [(r["text"], r["words"], r["link_density"], r["words_before"], r["link_density_before"], r["words_after"],
             r["main"] > 0.5) for r in got.orderBy("position").collect()]
    assert rows == [("Home page", 2, 1, 0, 0, 2, False), ("A title", 2, 0, 2, 1, 3, True),
                    ("one two three", 3, 1 / 3, 2, 0, 0, True)]


def test_given_pages_give_their_article(spark):
    """All pages of the small table: the texts of the paragraphs and headings of its article."""
    def expected(page):
        found = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)
        inner = re.sub(r"<[^>]*$", "", found[1]) if found else ""
        blocks = [" ".join(unescape(re.sub(r"</?\w+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        return "\n".join(b for b in blocks if b)

    path = "/root/testdata/sf0.01/pages.parquet"
    want = {r["page_id"]: expected(r["html"]) for r in pq.read_table(path).to_pylist()}
    assert {r["page_id"]: r["text"] for r in M.extract_text(spark.read.parquet(path)).collect()} == want

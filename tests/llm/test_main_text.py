"""Main text: given pages against SQL (the registered oracle), other layouts against their planted articles."""

from __future__ import annotations

import time

import duckdb
import pytest

from abx.llm import main_text as M

LONG = "This sentence is a part of the article and says something of some length about its topic, again and again."
PARTS = ["A headline of the day", LONG, "Short.", LONG + " Second.", "Ok", LONG + " Third & last."]
BODY = "<h1>A headline of the day</h1>" + "".join(f"<p>{p.replace('&', '&amp;')}</p>" for p in PARTS[1:])
MENU = "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(8))
COMMENT = "<p>I read this whole article twice and I think that it is wrong in nearly every one of its points.</p>"


LAYOUTS = {
    "article": f"<body><nav><ul>{MENU}</ul></nav><article>{BODY}</article><footer>&copy; all rights reserved here</footer>",
    "divs": f'<div id="top-menu"><ul>{MENU}</ul></div><div class="content">{BODY}</div><div class="footer">{LONG}</div>',
    "tables": f"<table><tr><td><a href=a>Home</a><td><a href=b>News</a></table><ul>{MENU}</ul><div>{BODY}</div><ul>{MENU}</ul>",
    "notice": f'<div class="cookie-consent"><p>{LONG} cookies</p><button>Accept all</button></div><main>{BODY}</main>',
    "sidebar": f'<div class="has-sidebar wrapper"><article>{BODY}</article><aside><h3>More</h3><p>{LONG} side</p></aside></div>',
    "comments": f'<article>{BODY}</article><section id="comments"><h2>Comments</h2>{COMMENT * 9}</section>',
    "nested comments": f'<main><article>{BODY}<div class="comment-list">'
    + f'<article class="comment">{COMMENT}</article>' * 9
    + "</div></article></main>",
    "form": f'<main>{BODY}<form><p>{LONG} Leave your address</p><label>Name</label><input><textarea>{LONG}</textarea></form></main>',
    "adverts": f'<article>{BODY.replace("<p>Ok</p>", f"<div class=ad-slot><p>{LONG} Buy now</p></div><p>Ok</p>")}</article>',
    "inline advert": f'<article>{BODY.replace("Short.", "Short.<span class=ad> Buy this now</span>")}</article>',
    "scripts": f"<script>var a = '<p>{LONG}</p>';</script><style>p:before{{content:'x'}}</style><!-- <p>{LONG}</p> --><div>{BODY}"
    "<noscript><p>Please switch on scripts</p></noscript></div>",
    "header": f"<header><p>{LONG} tagline</p><ul>{MENU}</ul></header><article><header>{BODY[:BODY.index('<p>')]}<p>By a writer</p>"
    f"</header>{BODY[BODY.index('<p>'):]}</article>",
    "unclosed": f"<nav><a href=/>Home</a></nav><article><b>{BODY.replace('</p>', '')}</article><footer>{LONG}",
    "nested main": f'<main><article>{BODY}</article><div><p>Written for the archive.</p></div></main>',
    "several articles": f"<article><h2>Teaser</h2><p>{LONG[:60]}</p></article><article>{BODY}</article>",
    "attributes": f'<div title="a > b" data-x=\'<p>no</p>\'>{BODY}</div>',
}


@pytest.mark.parametrize("layout", sorted(LAYOUTS))
def test_planted_article(layout):
    assert M.main_text("<!DOCTYPE html><html><head><title>T</title></head>" + LAYOUTS[layout]) == "\n".join(PARTS)


def test_links_and_lists_inside_the_article_stay():
    page = f'<div class="menu"><a href="/">x</a></div><article><p>{LONG}</p><ul><li><a href="/a">See also</a></li><li>Item</li></ul><p>{LONG}</p></article>'
    assert M.main_text(page).split("\n") == [LONG, "See also", "Item", LONG]


def test_white_space_and_references():
    page = "<p>  a&nbsp;b\n\t c<br>d&#233;&lt;b&gt; &amp;amp; &quot;x&quot; &bogus; 1 < 2</p>"
    assert M.main_text(page) == 'a b c dé<b> &amp; "x" &bogus; 1 < 2'


def test_a_short_article_is_whole():
    page = f"<nav>{MENU}</nav><div class='ad'>{LONG}</div><article><p>Hi.</p></article><footer>{LONG}</footer>"
    assert M.main_text(page) == "Hi."


@pytest.mark.parametrize("page", ["", "   ", "<p>", "<script>x", "<!-- x", "<html><body><nav>menu</nav></body></html>", "<a href='x"])
def test_pages_without_text(page):
    assert M.main_text(page) == ""


def test_spans():
    assert M.spans([0, 0, 90, 0, 3, 0, 0, 0, 5, 0]) == [(2, 5)]
    assert M.spans([0, 0, 4, 0, 0, 0, 0, 3]) == [(2, 3), (7, 8)]
    assert M.spans([100, 0, 0, 0, 100]) == [(0, 1), (4, 5)]
    assert M.spans([1], window=1) == [(0, 1)]
    assert M.spans([]) == [] and M.spans([0, 0]) == []


@pytest.mark.parametrize("piece", ["<a href=\"x", "<p ", "<div>", "<!--", "<script>", "<", "&", "<li><a href='q'>", "<div>x ", "<main>x ", "<div>y</p>", "<span>z ", "<article>x</article>"])
def test_long_malformed_pages_end_soon(piece):
    start = time.perf_counter()
    M.main_text(piece * 30_000)
    assert time.perf_counter() - start < 20


def test_given_pages_against_sql(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = sorted(tuple(r) for r in M.extract(pages).collect())
    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    assert got == sorted(con.execute(M.ORACLE).fetchall())


def test_defined_cases(spark):
    rows = [(1, "u", None), (None, None, f"<p>{LONG}</p>"), (2, "u", ""), (2, "u", "")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for c in ("k0", "text", "n_chars"):
        df = df.selectExpr("*", f"'x' AS {c}")
    got = sorted((tuple(r) for r in M.extract(df).collect()), key=repr)
    assert got == sorted([(1, "u", "", 0), (None, None, LONG, len(LONG)), (2, "u", "", 0), (2, "u", "", 0)], key=repr)
    assert M.extract(df.limit(0)).collect() == []

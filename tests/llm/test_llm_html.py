"""Main text of pages: the test tables by their own markup, planted pages, line blocks by brute force."""

import html
import random
import re

import pytest

from pyspark.sql import functions as F
from strata.llm import html_text as H
from strata.llm.queries import op13_html_extraction, table

from conftest import SF_SMALL


def by_article(page):
    """What the test tables' markup says: the blocks between <article> and </article>."""
    blocks = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    texts = [" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_query_on_all_pages(spark):
    rows = table(spark, SF_SMALL, "pages").collect()
    got = op13_html_extraction(spark, SF_SMALL)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: r for r in got.collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.page_id].text == by_article(r.html)
        assert got[r.page_id].url == r.url and got[r.page_id].n_chars == len(got[r.page_id].text)


def scan(weights, window):
    """Surges and dives by adding up every window anew."""
    sums = [sum(weights[max(0, i - window + 1):i + 1]) for i in range(len(weights) + window)]
    out, start = [], None
    for i, s in enumerate(sums):
        if s and start is None:
            start = i
        if not s and start is not None:
            inside = [j for j in range(start, min(i, len(weights))) if weights[j]]
            out.append((inside[0], inside[-1], max(sums[start:i])))
            start = None
    return out


def test_line_blocks_equal_sums_of_every_window():
    rng = random.Random(1)
    for _ in range(3000):
        weights = [rng.choice([0, 0, 0, 1, 5, 80]) for _ in range(rng.randint(0, 30))]
        window = rng.randint(1, 5)
        assert list(H.line_blocks(weights, window)) == scan(weights, window)


LONG = ["The river rose for three days before the bridge was closed to every kind of traffic in the valley.",
        "Engineers measured the flow at four places and compared it with records of the last forty years.",
        "By the weekend the water had fallen far enough for the first boats to cross from the northern bank."]
MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About</a></li></ul>'
EXTRAS = {
    "nav": f"<nav>{MENU}</nav>", "header": "<header><h2>The Daily Valley</h2><p>Founded long ago</p></header>",
    "footer": "<footer>&copy; 2020 The Daily Valley. All rights reserved.</footer>",
    "aside": "<aside><p>Other readers liked a long list of further stories, each with a summary.</p></aside>",
    "sidebar": '<div id="left-sidebar"><p>Weather: mild and dry, with some wind from the west in the evening.</p></div>',
    "ad": '<div class="ad">Buy a boat today, all boats are cheaper than ever before this week.</div>',
    "advert": '<section class="advertisement-slot top"><p>Boats!</p><p>Cheap boats of every size.</p></section>',
    "cookie": '<div class="cookieBanner" role="dialog"><p>We use cookies to make this page worse.</p></div>',
    "notice": '<p class="notice">Our office is closed on Monday, call us on Tuesday instead.</p>',
    "form": '<form action="/s"><label>Search the archive of all stories</label><input name="q"><button>Go</button></form>',
    "script": '<script>var a = "<p>not a text</p>"; if (a < 3 && b > 4) { track("</div>"); }</script>',
    "style": "<style>p > a { margin: 0 }</style>", "comment": "<!-- <p>not shown</p> -->",
    "noscript": "<noscript><p>Please turn on scripts to read everything.</p></noscript>",
    "hidden": '<div style="display: none"><p>Hidden words for machines only.</p></div>',
    "readers": '<section id="comments"><h3>2 comments</h3><article class="comment"><p>I crossed there as a child and '
               'remember the old ferry very well.</p></article><div class="reply"><p>So do I!</p></div></section>',
}


def page(body, before="", after=""):
    return (f'<!DOCTYPE html><html><head><title>T</title></head><body class="has-sidebar">{before}{body}{after}'
            "</body></html>")


@pytest.mark.parametrize("extra", sorted(EXTRAS))
@pytest.mark.parametrize("wrap", ["article", "main", "div", "body"])
def test_extras_go_from_every_place(extra, wrap):
    paragraphs = "".join(f"<p>{t}</p>" for t in LONG)
    body = {"article": f"<article><h1>Flood</h1>{paragraphs}</article>",
            "main": f"<main><h1>Flood</h1>{paragraphs}</main>",
            "div": f'<div class="page"><div class="content"><h1>Flood</h1>{paragraphs}</div></div>',
            "body": f"<h1>Flood</h1>{paragraphs}"}[wrap]
    want = "\n".join(["Flood", *LONG])
    assert H.main_text(page(body, before=EXTRAS[extra])) == want
    assert H.main_text(page(body, after=EXTRAS[extra])) == want
    if extra != "header":                  # a header inside an article is the article's own
        inside = body.replace("</p><p>", f"</p>{EXTRAS[extra]}<p>", 1)
        assert H.main_text(page(inside)) == want


def test_a_menu_without_names_is_found_by_its_links():
    body = f'<div><div>{MENU}</div></div><div><div><h1>Flood</h1>{"".join(f"<p>{t}</p>" for t in LONG)}</div></div>'
    assert H.main_text(page(body)) == "\n".join(["Flood", *LONG])


def test_nothing_else_is_dropped_or_capped():
    blocks = ["One", "word.", *LONG, "x" * 300_000, "End", "<b>", "a & b", "© and é", "nbsp here", "7 < 8 > 6"]
    body = "".join(f"<p>{html.escape(b)}</p>" for b in blocks)
    assert H.main_text(page(f"<article>{body}</article>")) == "\n".join(blocks)
    listing = "<article><ul><li>one</li><li>two <a href='/x'>linked</a></li></ul><table><tr><td>a</td><td>b</td></tr>" \
              "</table><pre>x\n  y</pre><blockquote><p>Said.</p></blockquote><p><a href='/y'>All linked</a></p></article>"
    assert H.main_text(listing) == "one\ntwo linked\na\nb\nx y\nSaid.\nAll linked"
    assert H.main_text("<article><p>in<b>li</b>ne <i>words</i><br>next\n\t line&nbsp;</p></article>") == \
        "inline words next line"


def test_broken_markup():
    assert H.main_text("<article><p><b>One.<br><p>Two</div><p>Three &amp four &am") == "One.\nTwo\nThree & four &am"
    assert H.main_text("<article><p>One.</p><p>Two. <a href=\"/cut") == "One.\nTwo."
    assert H.main_text("<article><p>One.</p><!-- cut <p>Two.</p>") == "One."
    assert H.main_text("<article><p>One.</p><script>cut <p>Two.</p>") == "One."
    assert H.main_text("<nav><a href='/'>Home</a><article><p>One.</p></article>") == "One."
    assert H.main_text("plain text\n only &lt;here") == "plain text only <here"
    assert H.main_text("<article><p title=it's>One.</p><p title='a>b'>Two.</p></article>") == "One.\nTwo."
    for empty in ("", "   ", "<html></html>", "<nav><a href='/'>Home</a></nav>", "<!--", "<", "<p", "</"):
        assert H.main_text(empty) in ("", "<")


def test_any_text_is_read():
    rng = random.Random(8)
    parts = ["<", ">", "</", "p", "<p>", "</p>", "<div class=\"", "'", "\"", "=", "<!--", "-->", "&#", "&#xD800;", "&amp",
             "text ", "<article>", "</article>", "<script>", "</script>", "<a href=x>", "</a>", "<li>", "\x00", "é"]
    for _ in range(3000):
        H.main_text("".join(rng.choice(parts) for _ in range(rng.randint(0, 40))))


def test_time_is_linear():
    for unit in ('<a b="', "<p", "<!--", "&#1", "</div>", "<div>", "<b><", "='x"):
        H.main_text(unit * 40_000)


def test_awkward_rows(spark):
    rows = [(1, "u", None, "t"), (1, "u", None, "t"), (None, None, "", "t"), (3, "v", "<p>" + "long words " * 400_000, "t"),
            (4, "w", "no markup", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    df = df.withColumn("__id", F.lit(1)).withColumn("n_chars", F.lit("x"))
    got = sorted(map(tuple, H.extract(df).collect()), key=str)
    assert got[0] == (1, "u", "", 0) and got[1] == (1, "u", "", 0) and got[-1] == (None, None, "", 0)
    assert got[2][3] == len("long words " * 400_000) - 1 and got[3] == (4, "w", "no markup", 9)
    assert H.extract(df.limit(0)).count() == 0
    broken = spark.range(1).select(F.lit(2).alias("page_id"), F.lit("u").alias("url"),
                                   F.expr("cast(unhex('3C703EFF61') as string)").alias("html"))
    assert H.extract(broken).first().text == "�a"

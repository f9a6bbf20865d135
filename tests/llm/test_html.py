import html as entities
import random
import re
import time

import pytest

from classweave.llm import html, queries

LONG = "This is a long paragraph of the article, with many words in it and hardly any markup at all, as articles have."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("body", "blocks"),
    [
        (f"<nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav><article><h1>Title</h1><p>{LONG}<p>Short.</article><footer>Imprint {LONG}</footer>", ["Title", LONG, "Short."]),
        (f"<div id=header>Site {LONG}</div><div class='sidebar left'>{LONG}</div><div class=content><p>{LONG}</p><p>{LONG}</p></div><div id=comments><p>{LONG}</p></div>", [LONG, LONG]),
        (f"<main><h2>A &amp; B&nbsp;C</h2>\n<p>One\n  two<br>three <b>bo</b>ld &#x41;</p><ul><li>item one<li>item two</ul><p>{LONG}</p><script>var x='</p>'</script></main>", ["A & B C", "One two three bold A", "item one", "item two", LONG]),
        (f"<div class=cookie-notice>{LONG}</div><article><p>{LONG}</p><aside>{LONG}</aside><form><input><label>{LONG}</label></form><div class='ad-slot ad'>Buy</div><p>End.</p><section class=comments><article class=comment>{LONG}</article></section></article>", [LONG, "End."]),
        (f"<div class=ad>never closed<article><p>{LONG}</p></article>", [LONG]),
        (f"<div><div><a href=1>One</a></div><div><a href=2>Two</a></div><div><a href=3>Three</a></div><p>{LONG}</p></div>", [LONG]),
        (f"<table><tr><td>a</td><td>b</td></tr><tr><td>c<td>d</table><p>{LONG}</p>", ["a b", "c d", LONG]),
        (f"<div class='has-sidebar sidebar-layout'><p>{LONG}</p><div class=siteFooter>{LONG}</div></div>", [LONG]),
        ("just text", ["just text"]),
        ("<nav>menu</nav>", []),
        (f"<p hidden>{LONG}</p><p style='display: none'>{LONG}</p><p>{LONG}", [LONG]),
    ],
)
def test_pages(body, blocks):
    assert html.main_text(page(body)).split("\n\n") == (blocks or [""])


@pytest.mark.parametrize("text", [None, "", " \n", "<", "<p", "<!--", "<script>", "</p></p>", "<p>a</", "&am", "<a " * 1000, "<div>" * 3000 + "deep", "<div>x" * 100_000, "<b><div>x</b>" * 50_000, "<article>x " * 50_000, "\x00<p>퟿</p>"])
def test_odd_pages_do_not_crash(text):
    assert isinstance(html.main_text(text), str)


def test_smoothing_keeps_constants_and_spreads_peaks():
    import numpy as np

    assert np.allclose(html.smooth(np.full(5, 3.0)), 3.0)
    peak = html.smooth(np.array([0, 0, 9.0, 0, 0, 0]))
    assert peak.argmax() == 2 and peak[1] == pytest.approx(peak[3], rel=0.2) and peak[5] == 0


def test_columns_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, page(f"<p>{LONG}</p>"), "x"), (1, page(f"<p>{LONG}</p>"), "x"), (2, None, None)], "page_id int, html string, text string")
    out = html.extract(df)
    assert out.columns == ["page_id", "html", "text", "text_"]
    assert sorted((r["page_id"], r["text_"]) for r in out.collect()) == [(1, LONG), (1, LONG), (2, "")]
    assert html.extract(df.where("false")).collect() == []


def test_the_query_against_the_given_pages(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.QUERIES["op7_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("kind", ["article", "main"])
@pytest.mark.parametrize(
    ("inner", "blocks"),
    [
        (f"<h2 id=discussion>Discussion</h2><p>{LONG}</p><h2 id='related-work'>Related work</h2><p id=search>{LONG}</p>", ["Discussion", LONG, "Related work", LONG]),
        (f"<p>{LONG}</p><section id='side-effects'><h3 id='side-effects-1'>Side effects</h3><p>{LONG}</p></section><section id=discussion><p>End.</p></section>", [LONG, "Side effects", LONG, "End."]),
        (f"<p>{LONG}</p><div class='search-results'>{LONG}</div>", [LONG, LONG]),
        (f"<p>{LONG}</p><h2>Sources</h2><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul>", [LONG, "Sources", "One", "Two", "Three"]),
        (f"<p>{LONG}</p><div class=related>Other</div><div class='social-share'>Share</div><div class='cookie-notice'>Ok</div><div class=comments><p>{LONG}</p></div><div id=comments>x</div>", [LONG]),
    ],
)
def test_articles_keep_their_parts(kind, inner, blocks):
    menu = "<div><div><a href=a>A</a></div><div><a href=b>B</a></div><div><a href=c>C</a></div></div>"
    assert html.main_text(page(f"{menu}<{kind}>{inner}</{kind}>{menu}")).split("\n\n") == blocks


@pytest.mark.parametrize("unit", ["<div>x", "<b>x", "<article>x ", "<p><b>", "<ul><li>x", "<b><div>x</b>", "<h1>x"])
def test_time_in_proportion_to_the_depth(unit):
    start = time.time()
    html.main_text(unit * 100_000)
    assert time.time() - start < 15


def test_the_heading_in_an_articles_own_header_stays():
    inner = f"<header><nav>menu</nav><h1>Title <b>bold</b></h1><p>By someone, 3 May</p></header><p>{LONG}</p>"
    menu = f"<header><h1>Site</h1><p>{LONG}</p></header>"
    for kind in ("article", "main"):
        assert html.main_text(page(f"{menu}<{kind}>{inner}</{kind}>")).split("\n\n") == ["Title bold", LONG]
        assert html.main_text(page(f"<{kind}><header class=ad><h1>Buy</h1></header><p>{LONG}</p></{kind}>")) == LONG


@pytest.mark.parametrize("seed", range(20))
def test_made_pages_without_an_article_element(seed):
    """Pages put together from known parts: only the parts of the text may come out, in order."""
    rng = random.Random(seed)
    words = "stone river cloud paper window garden market letter winter music".split()
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
    blocks = [sentence(rng.randint(15, 60)) for _ in range(rng.randint(4, 12))]
    blocks.insert(rng.randint(1, 3), sentence(3))
    marked = [f"<p>{b.replace(' ', rng.choice([' ', ' <b>x</b> '.replace('x', 'and'), '&#32;']), 1)}</p>" for b in blocks]
    text = [entities.unescape(re.sub("<[^>]*>", "", m)) for m in marked]
    aside = [
        f"<div class='{rng.choice(['sidebar', 'site-nav', 'cookie-banner', 'comments', 'newsletter-signup'])}'>{sentence(40)}</div>",
        f"<footer>{sentence(30)}</footer>", f"<nav><a href=x>{sentence(2)}</a></nav>", f"<script>var x = '{sentence(20)}';</script>",
        "<ul>" + "".join(f"<li><a href={k}>{sentence(2)}</a></li>" for k in range(5)) + "</ul>",
    ]
    rng.shuffle(aside)
    cut = rng.randint(0, len(aside))
    body = "".join(aside[:cut]) + f"<div id=content>{''.join(marked)}</div>" + "".join(aside[cut:])
    assert html.main_text(page(body)).split("\n\n") == [" ".join(x.split()) for x in text]

import html as H
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SMOKE
from tidewater.llm import html_text as X

LONG = "Many words that tell a story, one after the other, until the line is long enough to be read as prose."
NAV = "<nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two</a></li></ul></nav>"


def page(body, head="<title>T</title><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


ARTICLE = f"<article><h1>Title</h1><p>{LONG}</p><p>Be.</p><p>{LONG}</p></article>"
STORY = f"Title\n{LONG}\nBe.\n{LONG}"


@pytest.mark.parametrize("html, text", [
    (page(NAV + ARTICLE + "<footer>(c) all of us</footer>"), STORY),
    (page(f'<div class="cookie-notice">{LONG}</div><header><h2>Site</h2></header>' + ARTICLE + f"<aside>{LONG}</aside>"), STORY),
    (page(ARTICLE + f'<section id="comments"><article class="comment"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article></section>'), STORY),
    (page(ARTICLE.replace("<p>Be.", f'<div class="ad-box">{LONG}</div><form><p>{LONG}</p></form><script>x("</p>")</script><p>Be.')), STORY),
    (page(ARTICLE.replace("<h1>Title</h1>", "<header><h1>Title</h1><span>12 shares</span></header>")), STORY),
    (page("<nav><ul><li><a href=/a>One</a>" + ARTICLE), STORY),                                     # an unclosed menu
    (page('<div class="sidebar">Hot now' + ARTICLE), STORY),                                      # an unclosed sidebar
    (page("<form action=/x><input name=q>" + ARTICLE + "</form>"), STORY),                          # a form round the page
    (page(NAV + f'<div id="x1">Short</div><div id="story"><h1>Title</h1><div class="text"><p>{LONG}</p><p>Be.</p><p>{LONG}</p></div></div>'), STORY),
    (page(f"<div>Top</div>{NAV}<h1>Title</h1><p>{LONG}</p><p>Be.</p><p>{LONG}</p><div><a href=/c>more</a></div>"), STORY),
    (page(ARTICLE + "".join(f"<article><h2><a href=/{i}>Other {i}</a></h2></article>" for i in range(5))), STORY),
    (page(f"<main>{NAV}{ARTICLE}</main>"), STORY),
    (page(f"<main><h1>Title</h1><div><p>{LONG}</p><p>Be.</p></div><p>{LONG}</p></main>"), STORY),
    (f"<html><body>{NAV}{ARTICLE[:-10]}", STORY),                                                 # cut off
    (page(ARTICLE.replace("Be.", "Be.<br")), STORY.replace("Be.\n", "Be. Be.\n", 0)),
    (page("<article><p>a &amp; b&nbsp;&lt;c&gt;  &#8364;\n\t&copy x</p></article>"), "a & b <c> € © x"),
    (page("<article><p>one<br>two<b>three</b> four</p><ul><li>x<li>y</ul>tail</article>"), "one twothree four\nx\ny\ntail"),
    (page("<article><table><tr><td>a<td>b<tr><td>c</table><pre>p\n  q</pre></article>"), "a b\nc\np q"),
    (page('<article hidden><p>x</p></article><article role="main"><p>y y y y</p></article>').replace("<article hidden", "<section hidden").replace("</article><", "</section><", 1), "y y y y"),
    (page(NAV), ""),
    (page("<article><a href=/x>Only a link</a></article>"), "Only a link"),
    ("", ""), ("   ", ""), ("plain words", "plain words"), ("<![if x]>kept <![endif]>text", "kept text"), ("<", "<"),
])
def test_main_text(html, text):
    assert X.main_text(html) == text


def test_smoothing_and_threshold():
    s = X.smoothed(np.array([0.0, 0, 10, 0, 0]), 1.0)
    assert s.argmax() == 2 and s[1] == pytest.approx(s[3]) and 0 < s[0] < s[1]
    assert X.smoothed(np.full(30, 7.0)) == pytest.approx(np.full(30, 7.0))
    kernel = np.exp(-np.arange(-6, 7) ** 2 / 8)
    r = np.arange(20.0) % 7
    want = [sum(kernel[j + 6] * r[i + j] for j in range(-6, 7) if 0 <= i + j < 20) / sum(kernel[j + 6] for j in range(-6, 7) if 0 <= i + j < 20)
            for i in range(20)]
    assert X.smoothed(r) == pytest.approx(want)
    content, own = X.content_lines(np.array([1.0] * 10 + [90, 80, 2, 100, 90] + [1] * 10))
    assert content[10:15].all() and not content[[0, 1, 2, -3, -2, -1]].any()
    assert own.nonzero()[0].tolist() == [10, 11, 13, 14]
    assert not X.content_lines(np.zeros(3))[0].any()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div class=ad>", "</div>", "<article>", "</article>", "<a>", "</a>", "<td>", "<tr>",
                                 "<script>", "</script>", "<h1>", "<form>", "word ", "&amp", "<", "<!--", "-->", "<li>", "<![x", "<br/>"]), max_size=40))
def test_any_markup(parts):
    html = "".join(parts)
    text = X.main_text(html)
    assert text == "\n".join(" ".join(x.split()) for x in text.split("\n") if x.strip())


def test_deep_and_long_pages():
    deep = "<div>" * 30_000 + f"<article><p>{LONG}</p></article>"
    assert X.main_text(deep) == LONG
    text = X.main_text(page("<article>" + f"<p>{LONG}</p>" * 30_000 + "</article>"))
    assert text == "\n".join([LONG] * 30_000)


def articles_by_patterns(page_html):
    """The articles of the given pages, which have one form, by search and replace."""
    article = page_html[page_html.index("<article>"):].split("</article>")[0]
    blocks = re.split(r"</?(?:article|p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
    return "\n".join(b for b in (" ".join(H.unescape(x).split()) for x in blocks) if b)


def test_query_on_the_given_pages(spark):
    rows = {r.page_id: r for r in X.op12_html_extraction(spark, SMOKE).collect()}
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        assert rows[p.page_id].text == articles_by_patterns(p.html) and rows[p.page_id].n_chars == len(rows[p.page_id].text)
        assert rows[p.page_id].url == p.url


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "u", 1), (2, page(ARTICLE), "u", 2), (2, page(ARTICLE), "u", 2), (None, "", None, None), (3, "é", "é", 0)]
    df = spark.createDataFrame(rows, "page_id LONG, html STRING, text STRING, n_chars INT")
    got = X.extract(df)
    assert got.columns == ["page_id", "html", "n_chars", "text"]
    assert sorted((r.page_id or 0, r.text) for r in got.collect()) == [(0, ""), (1, ""), (2, STORY), (2, STORY), (3, "é")]
    assert X.extract(df.limit(0)).collect() == []

"""Main text of pages: the given ones by their article element, and hand-made layouts."""

from __future__ import annotations

import html
import re

import pytest

from tapeloom.llm import mainhtml
from tapeloom.llm import queries as Q

LONG = "This is a long enough sentence, with a clause; it says something of substance about the matter. "
SIDE = "<nav><ul><li><a href=/>Home</a><li><a href=/b>News, sport and more.</a></ul></nav>"


def plain(fragment: str) -> str:
    return " ".join(html.unescape(re.sub("<[^>]*>", "", fragment)).split())


def test_given_pages(spark, tables):
    rows = {r["page_id"]: r for r in Q.op13_html_extraction(spark, tables).collect()}
    given = spark.read.parquet(f"{tables}/pages.parquet").collect()
    assert len(rows) == len(given)
    for r in given:
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        want = "\n".join(x for x in map(plain, re.split("</?(?:p|h1)>", article.replace("<br>", " "))) if x)
        got = rows[r["page_id"]]
        assert (got["url"], got["text"], got["n_chars"]) == (r["url"], want, len(want))


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", '<div class="post-body x9">{}</div>', "<div>{}</div>", "<section class=c1><div>{}</div></section>", '<div class="wrap has-sidebar"><div class=story>{}</div></div>'])
def test_layouts(wrap):
    article = f"<h1>A title &amp; more</h1><p>{LONG * 3}</p><p>Short.</p><h2>Then</h2><p>{LONG}<b>bold</b>, <a href=/x>a link</a> &#8212; end.<ul><li>{LONG}</li><li>{LONG * 2}</ul><blockquote>{LONG}</blockquote>"
    page = f"""<!DOCTYPE html><html><head><title>Site. A title.</title><style>p {{ margin: 0 }}</style><script>if (a < b) document.write("<p>no</p>")</script></head><body class="single sidebar-right">
      <header><div>The Site, since 1990.</div>{SIDE}</header><div class="cookie-notice"><p>{LONG}</p></div><div class="alert alert-info"><p>{LONG}</p></div>{SIDE}<div class="ad-slot">{LONG}</div>
      {wrap.format(article + '<div class="ad">Buy this, now!</div>')}
      <aside><p>{LONG}</p></aside><section id="comments"><h3>Comments</h3><div class="comment-body"><p>{LONG * 4}</p></div></section><div class="related"><p>{LONG}</p></div>
      <form action=/s><label>Your mail, please.</label><textarea>{LONG}</textarea></form><footer><p>&copy; {LONG}</p></footer></body></html>"""
    bold = f"{LONG.strip()} bold, a link — end."
    want = ["A title & more", (LONG * 3).strip(), "Short.", "Then", bold, LONG.strip(), (LONG * 2).strip(), LONG.strip()]
    assert mainhtml.content(page) == "\n".join(want)


def test_markup_that_is_not_closed():
    assert mainhtml.content(f"<article><p>One, {LONG}<p>two <b>three<br>four <p title='a>b'>five < six &lt;b&gt; <!-- no --></article><p>") == f"One, {LONG.strip()}\ntwo three four\nfive < six <b>"
    assert mainhtml.content(f"<p>{LONG}<!-- never ends <p>{LONG}") == LONG.strip()
    assert mainhtml.content(f"<p>{LONG}<script>never ends <p>{LONG}") == LONG.strip()
    assert mainhtml.content(f"<p>{LONG}<a href='x") == LONG.strip()
    assert mainhtml.content(f'<p class="a>{LONG}</p><p>{LONG}</p>').count("long") == 2


def test_nothing_to_extract(spark):
    rows = [(1, "u", None, "t", 1), (2, None, "", "t", 1), (None, "u", SIDE, "t", 1), (3, "u", "no markup at all, just text", "t", 1), (3, "u", "no markup at all, just text", "t", 1), (4, "u", "<p>" + LONG * 20_000, "t", 1)]
    got = mainhtml.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert [(r["page_id"], r["text"][:5], r["n_chars"]) for r in got] == [(1, "", 0), (2, "", 0), (None, "", 0), (3, "no ma", 27), (3, "no ma", 27), (4, "This ", len((LONG * 20_000).strip()))]
    assert mainhtml.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_long_and_odd_pages_take_linear_time():
    for piece in ('<p title="', "<!--", "<a <a ", "<div>", "</div><p>", "<", "&#", "<script>"):
        mainhtml.content("<p>x, y." + piece * 20_000)

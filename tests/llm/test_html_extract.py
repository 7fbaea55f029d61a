import re
from html import unescape

import pytest

from creditframe.llm import html_extract as hx
from creditframe.llm import queries

SCHEMA = "page_id long, url string, html string, text string"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


LONG = "This is a sentence, with commas, that is long enough to be a paragraph of an article, as they go."


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("no markup at all", "no markup at all"),
        (page("<nav><a href=x>Menu</a></nav>"), ""),
        (page(f"<article><h1>A &amp; B</h1><p>one\n  two<br>three &lt;x&gt;</p><p>{LONG}</p></article><footer>f</footer>"),
         f"A & B\n\none two three <x>\n\n{LONG}"),
        (page(f"<header>Site</header><div id=content><h1>H</h1><p>{LONG}<p>{LONG} two</div><div class='side-bar sidebar'><p>{LONG}</p></div>"),
         f"H\n\n{LONG}\n\n{LONG} two"),
        (page(f"<div class='ad'>{LONG}</div><article><p><b>bold<br><p>{LONG}</article><div id=comments><p>{LONG} {LONG}</p></div>"),
         f"bold\n\n{LONG}"),
        (page(f"<article><p>{LONG}</p><aside>x</aside><form>y</form><div class=\"cookie-notice\">z</div><p>end</p></article>"),
         f"{LONG}\n\nend"),
        (page(f"<main><section><h2>a</h2><p>{LONG}</p></section><section><h2>b</h2><p>{LONG} 2</p></section></main>"),
         f"a\n\n{LONG}\n\nb\n\n{LONG} 2"),
        (page(f"<div><p>{LONG}</p></div><div><a href=1>{LONG}</a> <a href=2>{LONG}</a></div>"), LONG),
        (page(f"<article><p>a <em>b</em>c</p><ul><li>x<li>y</ul><pre>k\n l</pre><p>{LONG}</p></article>"), f"a bc\n\nx\n\ny\n\nk l\n\n{LONG}"),
        (page(f"<script>var t='</p><p>{LONG}';</script><!-- <p>{LONG}</p> --><article><p>{LONG}</p></article>"), LONG),
        (page(f"<article><header><h1>Top</h1></header><p>{LONG} 1 < 2</p></article>"), f"Top\n\n{LONG} 1 < 2"),
        (f"<article><p>{LONG}<p unfinished", LONG),
        (f"<article><p>{LONG}<!-- never ends", LONG),
    ],
)
def test_pages(html, text):
    assert hx.extract(html) == text


def test_deep_and_long_pages():
    assert hx.extract("<div>" * 20000 + LONG + "</div>" * 20000) == LONG
    assert hx.extract("<p>" + f"{LONG}<p>" * 5000).count("\n\n") == 4999
    assert hx.extract("<" * 20000) == "<" * 20000


def article_of(html):
    """The article of the generated pages, which all have the same frame."""
    inner = re.search(r"(?s)<article>(.*?)</article>", html)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in queries.table(spark, d, "pages").collect()}
    got = queries.REGISTRY["op2_html_extract"](spark, d).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == article_of(pages[r.page_id].html)


def test_rows(spark):
    rows = [(1, None, None, "x"), (2, "u", "", None), (3, "u", f"<p>{LONG}", None), (3, "u", f"<p>{LONG}", None)]
    got = sorted(map(tuple, hx.extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == [(1, None, ""), (2, "u", ""), (3, "u", LONG), (3, "u", LONG)]
    assert hx.extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0

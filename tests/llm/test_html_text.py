import html
import re

import pytest

from tabflow.llm import html_text as H
from tabflow.llm.queries import op4_html_text

SF = "/root/testdata/sf0.001"
BODY = "This is a long enough paragraph of the article, with several words and commas, to be its text."


def by_hand(page):
    """The article element of the fixture's pages, cut with plain patterns."""
    start = page.index("<article>") + len("<article>")
    end = page.find("</article>")
    blocks = re.split(r"</?(?:p|h1)>", page[start:end if end >= 0 else len(page)])
    texts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", b) if "<br>" in b else re.sub("<[^>]+>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_equals_article_cut_by_hand(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op4_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == by_hand(pages[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""), ("just words", "just words"),
    (f"<p>{BODY}<p>two &lt;b&gt; &amp; &eacute;&#233;&nbsp;x", f"{BODY}\n\ntwo <b> & éé x"),
    (f"<div class='top-menu'><a href=x>Home</a></div><div><p>{BODY}</p><p>A &b; c</p></div><div id='footer'>(c)</div>", f"{BODY}\n\nA &b; c"),
    (f"<body><header><h1>Site</h1></header><main><header><h2>Head</h2></header><p>{BODY}</p></main><aside>x</aside></body>", f"Head\n\n{BODY}"),
    (f"<article><p>{BODY}</p><section class='comments'><p>I say {BODY}</p></section></article>", BODY),
    (f"<div role=alert>We use cookies</div><article><p>{BODY}</p><div class=\"ad box\">Buy {BODY}</div></article>", BODY),
    (f"<script>var a = '<p>no</p>';</script><style>p > a {{}}</style><article>{BODY}<!-- <p>no</p> --></article>", BODY),
    (f"<article><h1>T</h1><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>{BODY}<br>more</article>", f"T\n\none\n\ntwo\n\na\n\nb\n\n{BODY} more"),
    (f"<form><input value=x><button>Go</button>Find</form><div class=ad><article><p>{BODY}</p></article></div>", BODY),
    (f"<article><p>a < b and 1 > 0 {BODY}", f"a < b and 1 > 0 {BODY}"),
    (f"<ARTICLE><P>{BODY}</P></ARTICLE><p hidden>secret</p>", BODY),
])
def test_pages(page, text):
    assert H.main_text(page) == text


def test_long_and_deep_pages_are_linear():
    deep = "<b>" * 30_000 + "x" + "</i>" * 30_000
    assert H.main_text(deep) == "x"
    long = "<article>" + "".join(f"<p>{BODY} {i}</p>" for i in range(20_000)) + "</article>"
    assert H.main_text(long).count("\n\n") == 19_999
    assert H.main_text('<a href="' * 20_000) is not None


def test_density_prefers_text_to_links():
    root = H.parse(f"<body><div><p>{BODY}</p><p>{BODY}</p></div><div>" + "<a href=x>link text here</a> " * 30 + "</div></body>")
    nodes = H.in_order(root)
    H.measure(nodes)
    text, links = (n for n in nodes if n.tag == "div")
    assert text.density > links.density


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", f"<p>{BODY}", "z"), (1, "u", f"<p>{BODY}", "z"), (None, None, None, None)],
                               "page_id long, url string, html string, text string")
    got = sorted((r["page_id"] or 0, r["url"], r["text"]) for r in H.extract(df).collect())
    assert got == [(0, None, ""), (1, "u", BODY), (1, "u", BODY)]
    assert H.extract(df.limit(0)).count() == 0


LONG = " ".join([BODY] * 12)


@pytest.mark.parametrize("page,text", [
    (f'<article><h1>T</h1><p>{LONG}</p><h2 id="related-work">Related work</h2><p>{LONG}</p></article>', ["T", LONG, "Related work", LONG]),
    (f'<article><p>{LONG}</p><section id="discussion"><h2>D</h2><p>{BODY}</p></section></article>', [LONG, "D", BODY]),
    (f'<article><p>{LONG}</p><section id="search-algorithms"><p>{BODY}</p></section></article>', [LONG, BODY]),
    (f'<article><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p></article>', ["Title", LONG]),
    (f'<body><div class="elementor-widget"><p>{LONG}</p><p>{BODY}</p></div><div class="widget"><a href=x>one</a> <a href=y>two</a></div></body>', [LONG, BODY]),
    (f'<body><div class="layout no-sidebar"><p>{LONG}</p><p>{BODY}</p></div><div class="sidebar"><p>Popular now</p></div></body>', [LONG, BODY]),
    (f'<body><div id="content"><p>{LONG}</p><p>{BODY}</p><div class="ad">Buy</div><div class="cookie-bar">We use cookies</div></div>'
     f'<div id="comments"><p>First!</p></div></body>', [LONG, BODY]),
    (f'<article><p>{LONG}</p><div class="related"><h3>More</h3><a href=a>one story</a> <a href=b>another story</a></div></article>', [LONG]),
    (f'<article><p>{LONG}</p><div class="share"><h4>Tell others</h4></div><div class="notice">Closed today.</div></article>', [LONG]),
])
def test_names_mark_and_density_decides(page, text):
    assert H.main_text(page) == "\n\n".join(text)


def test_many_nested_marks_are_linear():
    assert H.main_text('<div class="widget" id="header">' * 20_000 + f"<p>{LONG}</p>") == LONG

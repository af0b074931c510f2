"""Operator 11 against an independent reading of the pages, and on odd pages."""

import re
from html import unescape

import pytest

from orderlens.llm import html_extract, queries
from orderlens.llm.html_extract import main_text

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute(html):
    """These pages have one ``article`` of headings and paragraphs; it may be cut off."""
    found = re.search(r"<article>(.*?)(</article>|$)", html, re.S)
    if not found:
        return ""
    body = re.sub(r"<[^>]*$", "", found[1])
    parts = re.split(r"</?(?:p|h1)>", body)
    out = [" ".join(unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))).split()) for p in parts]
    return "\n".join(x for x in out if x)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_whole_table_against_brute_force(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op11_html_extract(spark, sf).collect()}
    assert len(got) == len(pages)
    for p in pages:
        want = brute(p.html or "")
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, want, len(want))


LONG = "This is a long paragraph, with commas, and text. It has several sentences; it is the article."


def test_page_without_any_marks_is_chosen_by_ratios():
    html = f"""<body class="has-sidebar"><div class="page"><div id="t1"><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a>
    </li><li><a>Contact</a></li></ul></div><div class="c1"><h2>A title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div>
    <div class="x"><a href=1>Read this next</a> <a href=2>And that one</a></div><div class="ftr">All rights</div></div>"""
    assert main_text(html) == f"A title\n{LONG}\nShort.\n{LONG}"


def test_struck_out_parts_and_marked_article():
    html = f"""<header><h1>Site</h1></header><main><article><header><h1>Title &amp; more</h1></header><p>One &lt;b&gt; x
    <p>Two&nbsp;words<ul><li>item one<li>item <b>t</b>wo</ul><form><input><label>Mail</label></form>
    <div class="cookie-notice">We use cookies</div><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul></article>
    <section class="comments"><article class="comment"><p>{LONG} {LONG}</p></article></section></main>
    <aside>Side</aside><div class="ad">{LONG}</div><script>if (a<b) document.write("<p>no</p>")</script>
    <style>p{{}}</style><footer>&copy; x</footer>"""
    assert main_text(html) == "Title & more\nOne <b> x\nTwo words\nitem one\nitem two"


@pytest.mark.parametrize("html, want", [
    ("", ""), ("<html><head><title>x</title></head><body><nav>a</nav></body></html>", ""),
    ("just text & <3 &amp;amp; more", "just text & <3 &amp; more"), ("<article><p>abc def<p>x &am", "abc def\nx &am"),
    ("<article><p>abc <b cla", "abc"), ("<p title=\"a>b\">one</p><P title='x\">y'>two</P>", "one\ntwo"),
    ("<article>a<br>b<!-- c --> d<hr>e</article>", "a b d\ne"), ("<main><p>a</main><p>b", "a"),
    ("<article><p><b>a</p><p>b</b> c</article>", "a\nb c"), ("<article><pre>a\n  b</pre><table><tr><td>1<td>2</table>", "a b\n1\n2"),
    ("<article>\U0001F600 &#x1F600; &#233;</article>", "\U0001F600 \U0001F600 é")])
def test_markup(html, want):
    assert main_text(html) == want


def test_heading_outside_the_node():
    assert main_text(f"<div><h1>T</h1></div><div class=content><p>{LONG}</div>") == f"T\n{LONG}"


def test_hostile_pages_take_linear_time():
    import time
    start = time.time()
    for html in ("<" * 200_000, '<a "' * 100_000, "<div>" * 100_000 + "deep" + "</div>" * 100_000, "<p>" * 100_000 + "x",
                 "<a b=" * 100_000, "<!--" * 100_000, "<b>x<p>" * 50_000, "<b>" * 50_000 + "x<hr>" * 50_000):
        main_text(html)
    assert time.time() - start < 60


def test_odd_rows(spark):
    rows = [(1, None, None, "k"), (1, None, None, "k"), (2, "u", "", "k"), (None, "v", "<article>x y</article>", None),
            (3, "w", "<article>" + "<p>long page text. " * 200_000, "k")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(map(tuple, html_extract.extract(pages).collect()), key=str)
    big = "\n".join(["long page text."] * 200_000)
    assert got == sorted([(1, None, "", 0), (1, None, "", 0), (2, "u", "", 0), (None, "v", "x y", 3), (3, "w", big, len(big))],
                         key=str)
    assert html_extract.extract(pages.limit(0)).count() == 0

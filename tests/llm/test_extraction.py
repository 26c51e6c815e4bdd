import html
import re

import pytest
from conftest import DATA

from tallyroom.llm import extraction, queries


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


LONG = "Some longer sentence of the article that stands in a paragraph of its own"


def plain_article(text):
    """The given tables hold one well-marked article each: cut it out with patterns."""
    inside = re.search(r"<article>(.*?)</article>", text, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1)>", inside)
    clean = [" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "")).split()) for b in blocks]
    return "\n".join(b for b in clean if b)


def test_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    got = {r["page_id"]: r for r in queries.QUERIES["op13_host_consensus"](spark, DATA).collect()}
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["page_id"]]["text"] == plain_article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"]) and got[r["page_id"]]["url"] == r["url"]


@pytest.mark.parametrize("body, expected", [
    (f"<nav><p>{LONG}</p></nav><article><h1>Head</h1><p>One &amp; two</p><p>{LONG}</p></article><footer>f</footer>", f"Head\nOne & two\n{LONG}"),
    (f"<div class=menu><ul><li>a<li>b</ul></div><div id=content-12><p>{LONG}<p>second  one<br>line</div>", f"{LONG}\nsecond one line"),
    (f"<article><header><p>by me</p><h2>Head</h2></header><p>{LONG}</p><div class='related-posts'><p>{LONG}</p></div></article>", f"Head\n{LONG}"),
    (f"<article><p>{LONG}</p><section id=comments><p>{LONG} {LONG}</p></section></article>", LONG),
    (f"<main><p>{LONG}</p><form><p>Your mail</p></form><aside>x</aside><div role=alert>cookies</div></main>", LONG),
    (f"<main><section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>{LONG}</p></section></main>", f"A\n{LONG}\nB\n{LONG}"),
    (f"<article><p>{LONG}</p><p hidden>no</p><p style='display: none'>no</p><script>var t='</p><p>x';</script><!-- <p>c</p> --></article>", LONG),
    (f"<article><ul><li>first <a href='x>y'>link</a></li><li>second</li></ul><p>{LONG} 1 < 2 &copy; &#233; &nbsp; x</p></article>",
     f"first link\nsecond\n{LONG} 1 < 2 © é x"),
    (f"<article><table><tr><td>a<td>b</table><pre>x\n  y</pre><p>{LONG}", f"a\nb\nx y\n{LONG}"),
    ("just text", "just text"),
    ("", ""),
])
def test_one_page(body, expected):
    assert extraction.main_text(page(body), None) == expected


def test_pages_that_end_anywhere():
    whole = page(f"<article><p>{LONG}</p><p class='a'>two</p></article>")
    for end in range(len(whole)):
        extraction.main_text(whole[:end], None)
    assert extraction.main_text(None, None) == "" and extraction.main_text("", "html") == ""


def test_the_host_decides(spark):
    """One page's own best container is the comment-like box; its host's other pages outvote it."""
    usual = page(f"<div class='wrap'><div class='story x9'><p>{LONG}</p><p>{LONG}</p></div><div class='box'><p>side</p></div></div>")
    odd = page(f"<div class='wrap'><div class='story x7'><p>short</p></div><div class='box'><p>{LONG}</p><p>{LONG}</p></div></div>")
    rows = [(i, f"https://A.example/{i}", usual) for i in range(9)] + [(9, "http://a.example?x", odd), (10, None, odd), (11, "no host", odd)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r["path"] for r in extraction.winning_paths(frame).collect()] == [">html>body>div.wrap>div.story.x"]
    got = {r["page_id"]: r["text"] for r in extraction.extracted(frame).collect()}
    assert got[0] == f"{LONG}\n{LONG}" and got[9] == "short"
    assert got[10] == got[11] == f"{LONG}\n{LONG}"


def test_hard_rows(spark):
    rows = [(1, None, None), (1, None, None), (2, "http://x.y/", ""), (None, "http://x.y/", "<p>" + "w " * 400_000), (3, "://", "<"), (4, "", "<p")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as path", "2 as host")
    out = extraction.extracted(frame)
    assert out.columns == ["page_id", "url", "html", "path", "host", "text", "n_chars"]
    got = sorted((str(r["page_id"]), r["n_chars"]) for r in out.collect())
    assert got == [("1", 0), ("1", 0), ("2", 0), ("3", 1), ("4", 0), ("None", 799_999)]
    assert extraction.extracted(frame.limit(0)).count() == 0

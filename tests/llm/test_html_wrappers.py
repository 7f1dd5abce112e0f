"""Main-text extraction: hand-made hosts, tables, and the inference of expressions."""

import html
import random
import re

import pytest

from tests.llm.conftest import TESTDATA, rows_of
from tripmill.llm.html_wrappers import (
    KINDS,
    Node,
    decide,
    expression,
    extract_main_text,
    fold,
    host_of,
    infer_wrappers,
    main_text,
    merge,
    parse,
)
from tripmill.llm.queries import op12_html_extraction

WORDS = "river stone lamp quiet meadow copper engine winter paper signal harbor candle forest thunder window garden".split()


def sentence(rng, n=14):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def wrapper(*pages):
    whole = fold(parse(pages[0]))
    for page in pages[1:]:
        whole = merge(whole, fold(parse(page)))
    return whole


def test_expression_of_optional_repeated_and_slot():
    found = wrapper(
        "<body><h1>A</h1><p>one</p><p>two</p><div class=promo>buy</div><footer>same</footer></body>",
        "<body><h1>B</h1><p>one</p><footer>same</footer></body>",
    )
    assert expression(found) == 'html(body(h1(#) p(#)+ div.promo("buy")? footer("same")))'


def test_expression_of_repeated_groups():
    found = wrapper("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b<dt>e<dd>d<dt>f<dd>g</dl>")
    assert expression(found) == "html(dl({ dt(#)+ dd(#)+ }+))"
    found = wrapper("<h2>a</h2><p>b</p><ul><li>x</ul><p>c</p><h2>d</h2><p>e</p>", "<p>b</p>")
    assert expression(found) == 'html({ h2(#)* p(#)+ ul(li("x"))? }+)'


def test_packed_wrappers_come_back():
    found = wrapper("<div><p>a</p><p>b</p></div>", "<div><p>c</p></div><aside>x</aside>")
    assert expression(Node.unpacked(found.packed())) == expression(found)


def semantic(rng, n):
    body = [sentence(rng) for _ in range(rng.randint(1, 6))]
    page = (
        f"<!doctype html><html><head><title>t</title><script>if (1<2) x='</p>';</script></head><body>"
        f"<header><a href=/>Home</a><h1>Site {n % 3}</h1></header><nav><ul><li><a href=a>{sentence(rng, 2)}</a><li><a>b</a></ul></nav>"
        f"<main><article id=post-{n}><header><h1>Title {n}</h1><span>by <a>Ann</a></span></header>"
        + "".join(f"<p>{x}" for x in body)
        + f"<div class='ad'>Buy {sentence(rng)}</div><form><label>Mail</label><input></form>"
        f"<section id=comments><article class=comment><p>{sentence(rng)}</p></article></section></article></main>"
        f"<aside>{sentence(rng)}</aside><div class='cookie-notice'>We use cookies {sentence(rng)}</div><footer>&copy; {n}</footer></body></html>"
    )
    return page, "\n".join([f"Title {n}", "by Ann", *body])


def classless(rng, n):
    """Nothing but plain divs: only what the host repeats, and where its text lies, tells the parts apart."""
    body = [sentence(rng, 25) for _ in range(rng.randint(3, 7))]
    page = (
        "<html><body><div><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li><li><a href=/c>Contact us</a></li></ul></div>"
        + ("<div>Special offer of the week</div>" if n % 2 else "")
        + "<div>" + f"<h2>Head {n}</h2>" + "".join(f"<p>{x}</p>" for x in body) + "<div>Follow us for more</div></div>"
        + "<div>All rights reserved by the publisher</div></body></html>"
    )
    return page, "\n".join([f"Head {n}", *body])


def tables(rng, n):
    body = [sentence(rng, 20) for _ in range(rng.randint(2, 5))]
    page = (
        "<TABLE><TR><TD><A HREF=x>Index</A><TD><A HREF=y>Up</A><TR><TD>" + "".join(f"<P>{x}" for x in body)
        + "</TABLE><hr><address>Maintained by the web team</address>"
    )
    return page, "\n".join(body)


@pytest.mark.parametrize("make", [semantic, classless, tables])
def test_hosts(spark, make):
    rng = random.Random(9)
    made = [make(rng, n) for n in range(40)]
    rows = [(n, f"https://user@WWW.{make.__name__}.org:80/p{n}", page) for n, (page, _) in enumerate(made)]
    out = extract_main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5))
    got = {r.page_id: r.text for r in out.collect()}
    assert got == {n: text for n, (_, text) in enumerate(made)}


def plain_article(page):
    """The text of the one article element of the test tables."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|ul|li|div)\b[^>]*>", re.sub(r"<br>", " ", inner))
    cleaned = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in blocks)
    return "\n".join(x for x in cleaned if x)


def test_table(spark):
    rows = spark.read.parquet(f"{TESTDATA}/pages.parquet").collect()
    want = sorted(((r.page_id, r.url, t := plain_article(r.html), len(t)) for r in rows), key=repr)
    assert rows_of(op12_html_extraction(spark, TESTDATA), "page_id", "url", "text", "n_chars") == want


def test_defined_results(spark):
    long = "<body>" + "<div>" * 3000 + "deep text " + "</div>" * 3000 + "<p>after</p>"
    rows = [
        (1, None, None), (2, "http://a.org", None), (3, "http://a.org", ""), (4, None, "just &amp; text \n here"), (5, "not a url", "<p>a</p><p>b"),
        (5, "not a url", "<p>a</p><p>b"), (None, "http://b.org/", "<p>x &lt;b&gt;&nbsp; y</p>"), (7, "http://c.org", long),
        (8, "//d.org/x", "<nav>only a menu</nav>"), (9, "http://e.org", "<a href='unclosed>x<p>y"), (10, "http://f.org", "<!-- never closed <p>z"),
        (11, "http://g.org", "&amp;lt;p&amp;gt; 1 < 2"), (12, "http://h.org", "<p>" + "word " * 200_000),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 host", "'p' plan", "2 text")
    out = extract_main_text(frame)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {}
    for r in out.collect():
        got.setdefault(r.page_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    assert got[1] == got[2] == got[3] == got[10] == [""]
    assert got[4] == ["just & text here"] and got[5] == ["a\nb"] * 2 and got[None] == ["x <b> y"]
    assert got[7] == ["deep text\nafter"] and got[8] == [""]
    assert got[11] == ["&lt;p&gt; 1 < 2"] and len(got[12][0]) == 200_000 * 5 - 1
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract_main_text(empty).collect() == []


def test_one_wrapper_a_host_through_rounds(spark, monkeypatch):
    monkeypatch.setattr("tripmill.llm.html_wrappers.FAN", 2)
    rng = random.Random(4)
    rows = [(f"http://one.org/{n}" if n % 3 else f"http://two.org/{n}", semantic(rng, n)[0]) for n in range(60)]
    found = infer_wrappers(spark.createDataFrame(rows, "url string, html string").repartition(12)).collect()
    assert sorted((r.host, r.pages) for r in found) == [("one.org", 40), ("two.org", 20)]
    assert all("article" in r.expression and "!" in r.plan for r in found)


def test_many_kinds_of_parts_stay_bounded():
    pages = ["<body>" + "".join(f"<div class='{a}{b}'><p>{a}{b}</p></div>" for b in "abcdefghijklmnop") + "</body>" for a in "qrstuvwxyz"]
    found = wrapper(*pages)
    assert len(found.kids[0].kids) <= KINDS < 160
    assert main_text(pages[0], decide(found)) == "\n".join(f"q{b}" for b in "abcdefghijklmnop")


def test_hosts_of_urls(spark):
    urls = {"HTTP://A.b:8/x": "a.b", "//c.d?x": "c.d", "https://u:p@e.f#g": "e.f", "mailto:x@y": None, "": None, None: None, "a.b/c": None}
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.host for r in frame.withColumn("host", host_of(frame.url)).collect()} == urls

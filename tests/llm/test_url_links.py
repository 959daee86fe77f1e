"""Links that markup shows between urls, against pairs written out by hand."""

from __future__ import annotations

import time

import pytest

from quarryline.llm import url_filter

PAGE = "https://a.org/x/y/page.html?q=1"

CASES = [
    ('<link rel="canonical" href="https://b.org/1">', "https://b.org/1"),
    ("<LINK HREF=https://b.org/2 REL=Canonical>", "https://b.org/2"),
    ('<link rel="nofollow canonical" href="https://b.org/3">', "https://b.org/3"),
    ('<link title="a > b" rel="canonical" href="https://b.org/4">', "https://b.org/4"),
    ('<link rel="canonical" href="https&#58;//b.org&#x2F;5?a=1&amp;b=2">', "https://b.org/5?a=1&b=2"),
    ('<base href="https://c.org/d/"><link rel="canonical" href="6">', "https://c.org/d/6"),
    ('<link rel="canonical" href="7"><base href="/e/f">', "https://a.org/e/7"),
    ('<link rel="canonical" href="../8">', "https://a.org/x/8"),
    ('<link rel="canonical" href="../../../../9/./z/..">', "https://a.org/9/"),
    ('<link rel="canonical" href=" //B.org/10#part ">', "https://b.org/10"),
    ('<link rel="canonical" href="?p=11">', "https://a.org/x/y/page.html?p=11"),
    ('<link rel="&#99;anonical" href="https://b.org/12">', "https://b.org/12"),
    ('<meta http-equiv="refresh" content="0; url=https://b.org/13">', "https://b.org/13"),
    ("<meta content=\"5;URL='https://b.org/14'\" http-equiv=Refresh>", "https://b.org/14"),
    ('<meta http-equiv="refresh" content="&#48;;url=/15">', "https://a.org/15"),
    ('<link rel="canonical" href="https://b.org/16" href="https://no.org/">', "https://b.org/16"),
    ('<p title="<!--"><link rel="canonical" href="https://b.org/17"><p title="-->">', "https://b.org/17"),
    ('<script>"<!--"</script><link rel="canonical" href="https://b.org/18">', "https://b.org/18"),
    ('<link rel="canonical" href="/%C3%A4&#xE4;&unknown;&#0;">', "https://a.org/%C3%A4ä&unknown;�"),
    ('<!-- <link rel="canonical" href="https://no.org/1"> -->', None),
    ('<script>var s = \'<link rel="canonical" href="https://no.org/2">\';</script>', None),
    ('<title><link rel="canonical" href="https://no.org/3"></title>', None),
    ('<p title=\'<link rel="canonical" href="https://no.org/4">\'>', None),
    ('<link title=" rel=canonical " href="https://no.org/5">', None),
    ('<link rel="canonical-like" href="https://no.org/6">', None),
    ('<linked rel="canonical" href="https://no.org/7">', None),
    ('<meta http-equiv="refresh" content="30">', None),
    ('<link rel="canonical" href="mailto:canonical@no.org">', None),
    ('<link rel="canonical">', None),
    ('<link rel="canonical" href="">', None),
    ("<!-- never closed <link rel=canonical href=https://no.org/8>", None),
    ("canonical", None),
    ("", None),
    (None, None),
]


def test_links_of_markup(spark):
    schema = "url string, html string, a string, link string"
    frame = spark.createDataFrame([(f"{PAGE}&case={i}", html, "x", "y") for i, (html, _) in enumerate(CASES)], schema)
    found = {(r.a, r.b) for r in url_filter.alias_links(frame).collect() if r.b is not None}
    expected = {(f"{PAGE}&case={i}", node) for i, (_, node) in enumerate(CASES) if node is not None}
    assert found == expected
    no_urls = spark.createDataFrame([(None, CASES[0][0]), ("no url", CASES[0][0])], "url string, html string")
    assert [r.a for r in url_filter.alias_links(no_urls).collect()] == [None]
    assert url_filter.alias_links(frame.limit(0)).count() == 0


@pytest.mark.parametrize("piece", ['<a "', "<a x=\"", "<!--", "<script>", "<link rel=canonical ", "<a x='\"", '="" ', "&#", "<title"])
def test_broken_markup_takes_linear_time(spark, piece):
    html = "<link rel=canonical href=https://b.org/>" + piece * (1_000_000 // len(piece))
    frame = spark.createDataFrame([(PAGE, html)], "url string, html string")
    start = time.monotonic()
    assert [r.b for r in url_filter.alias_links(frame).collect()][:1] == ["https://b.org/"]
    assert time.monotonic() - start < 30

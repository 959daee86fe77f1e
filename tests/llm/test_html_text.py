"""What decides on the main text of a page: the distribution, names that are overruled, links, broken markup."""

import re
import time

import pyarrow.parquet as pq
import pytest

from quarryline.llm import html_text

LONG = "The text of this page goes on for some time. " * 8


@pytest.mark.parametrize(
    "name", ["sidebar-right", "post social-science", "main-content search-page", "comment-rules", "menu-item-page", "post tags-none", "sidebar", "comments"]
)
def test_a_name_does_not_empty_the_page(name):
    page = f'<body><nav><a href=x>Home</a></nav><div class="{name}"><h1>Head</h1><p>{LONG}</p><p>Short.</p></div><footer>&copy; me</footer></body>'
    assert html_text.main_text(page) == f"Head {LONG}Short."


def test_names_are_believed_beside_an_article():
    for around in ("div class=comments", "section id=comments", "aside", "div class=sidebar", "form"):
        page = f"<body><div><p>{LONG}</p><p>End.</p></div><{around}>{'<p>Nice! ' * 60}</{around.split()[0]}>"
        assert html_text.main_text(page) == f"{LONG}End."
    hinted = f"<div><p>{LONG}</p><div class=share-buttons>Share this</div><p>End.</p></div>"
    assert html_text.main_text(hinted) == f"{LONG}End."
    form = f"<form><div class=nav>Menu</div><div><p>{LONG}</p></div></form>"
    assert html_text.main_text(form) == LONG.strip()


def test_links_weigh_nothing():
    links = "".join(f"<li><a href=/{i}>A heading of another page, number {i}</a></li>" for i in range(9))
    assert html_text.main_text(f"<div><ul>{links}</ul></div><div><p>{LONG}</p></div><div>{links}</div>") == LONG.strip()
    inside = f"<div><p>{LONG}</p><p><a href=x>Source</a></p><p>See <a href=y>there</a> for more of it, and so on.</p></div>"
    assert html_text.main_text(inside) == f"{LONG}Source See there for more of it, and so on."


def test_pages_without_names(sf_dir):
    """With every element a div and no classes, most of the article is still told from what surrounds it."""
    found = []
    for row in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist():
        wanted = html_text.main_text(row["html"]).split()
        plain = re.sub(r"(</?)(?!script|style|title|a[ >])([a-zA-Z][a-zA-Z0-9]*)[^>]*>", r"\1div>", row["html"])
        seen = html_text.main_text(plain).split()
        both = sum(min(wanted.count(w), seen.count(w)) for w in set(wanted))
        found.append(both / (len(wanted) + len(seen) - both))
    assert sum(found) / len(found) > 0.85


def naive_end(page, at):
    quote = ""
    for i in range(at, len(page)):
        if quote:
            quote = "" if page[i] == quote else quote
        elif page[i] in "\"'":
            quote = page[i]
        elif page[i] == ">":
            return i + 1
    return -1


def test_ends_of_tags():
    for page in ("<a>", "<a b='>'>", "<a b=\"'>\" c='\">'>x", "<a \"<b '>\">", "<a '", "", "<a <b <c>", "''\"\">'>'>\""):
        ends = html_text.tag_ends(page)
        assert [ends(at) for at in range(len(page) + 1)] == [naive_end(page, at) for at in range(len(page) + 1)]


@pytest.mark.parametrize(
    "unit", ['<a "', "<a <b '", "<", "<!--", "<div>", "x<nav><div>", "<a href=x>y", "</b><div>", "<p><i>z", "&amp", "<script>", "<div class='", "t<div>"]
)
def test_broken_markup_takes_linear_time(unit):
    def seconds(size):
        page = unit * (size // len(unit))
        start = time.process_time()
        html_text.main_text(page)
        return time.process_time() - start

    seconds(10_000)
    assert seconds(1_000_000) < 20


def test_a_megabyte_of_open_quotes():
    start = time.process_time()
    html_text.main_text('<a "' * 250_000)
    assert time.process_time() - start < 2

"""Text that is visible whatever its element's other attributes hold."""

import time

import pytest

from colophon.llm import html_text
from colophon.llm.html_text import leaf_blocks


@pytest.mark.parametrize("page", [
    '<p><a href="/the-hidden-cost">kept</a></p>', '<p title="hidden gems">kept</p>', "<p data-hidden>kept</p>", "<p title='style=\"display:none\"'>kept</p>",
    "<p data-x=hidden>kept</p>", "<p><math><mi>kept</mi></math></p>", "<object data=x.swf><p>kept</p></object>", '<p aria-hidden="false">kept</p>',
])
def test_visible(page):
    assert [b.text for b in leaf_blocks(page)] == ["kept"]


@pytest.mark.parametrize("attrs", ["hidden", 'class="a" HIDDEN', 'hidden=""', "aria-hidden=true", 'title="x" aria-hidden = "true"', "style='display: none'", "/hidden"])
def test_hidden(attrs):
    assert leaf_blocks(f"<p {attrs}>gone</p>") == []


def test_listings_are_shown_as_they_stand():
    got = leaf_blocks("<p>a<xmp class=code>x &lt; <b>y</b>\n  z</xmp>b</p><xmp hidden>gone</xmp><div style='display:none'><xmp>gone</xmp></div><xmp>open <p>")
    assert [b.text for b in got] == ["a", "x &lt; <b>y</b> z", "b", "open <p>"] and got[1].marks == ("code",)


def test_marks_come_from_their_attributes():
    assert leaf_blocks('<p data-class="no" title="id=no" class="Main text" id=top>x</p>')[0].marks == ("main", "text", "top")


@pytest.mark.parametrize("page", ["<a " * 350_000, "<a \"" * 250_000 + '"', "<a '" * 250_001, "<div>x" * 100_000, "<p><span>" * 100_000, "<span>" * 50_000 + "<td>" + "<div></div>" * 50_000, "<span>" * 50_000 + "<li>x</li>" * 50_000, "<script></script" * 60_000, "<!--" * 250_000, "<!-- -->" * 100_000, "<" * 1_000_000, "".join(f"<x{k}>y" for k in range(60_000)), "&#" + "9" * 100_000 + "; &#" + "0" * 100_000 + "65;", "</p>" * 250_000])
def test_broken_pages_take_linear_time(page):
    began = time.time()
    html_text.block_features(leaf_blocks(page))
    assert time.time() - began < 20


def test_broken_markup():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts('<p title="never closed>a</p><p>b') == ["a", "b"]
    assert texts("1 < 2 <3 <p>x<!-- c -->y<? z ?>") == ["1 < 2 <3", "xy"]
    assert texts("<li>a<li>b<ul><li>c</ul>d") == ["a", "b", "c", "d"]
    assert texts("<p>a<div>b</p>c</div>") == ["a", "b", "c"]
    assert texts("&#0000065;&#99999999999; &amp;lt;") == ["A\ufffd &lt;"]

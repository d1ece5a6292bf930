"""Blocks of pages against the standard library's parser; damaged pages lose no text."""

import time
from html.parser import HTMLParser

import pytest

from loomline.llm import html
from tests.llm.conftest import SF

WORDS = "word " * 40
TREE = html.train()


class Plain(HTMLParser):
    """Block texts with their number of linked characters, for well-formed pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.hidden, self.links = [], "", 0, 0

    def cut(self):
        if text := " ".join(self.now.split()):
            self.out.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in (*html.RAW, *html.HIDDEN):
            self.now += " "
            self.hidden += 1
        if tag in html.BLOCK_TAGS:
            self.cut()
        self.now += " " * (tag == "br")

    def handle_endtag(self, tag):
        self.hidden -= tag in (*html.RAW, *html.HIDDEN)
        if tag in html.BLOCK_TAGS:
            self.cut()

    def handle_data(self, data):
        if not self.hidden:
            self.now += data


def test_blocks_are_those_of_another_parser(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect() if r.html]
    assert pages
    for page in pages:
        plain = Plain()
        plain.feed(page)
        plain.close()
        plain.cut()
        assert [b.text for b in html.blocks(page)] == plain.out


@pytest.mark.parametrize("page, kept", [
    (f"<article><iframe src='x'/><p>{WORDS}", WORDS),
    (f"<article><iframe src='x'><p>{WORDS}</article>", WORDS),
    (f"<article><button>Menu<p>{WORDS}</article>", WORDS),
    (f"<article><button><div>Menu</div></button><p>{WORDS}</article>", WORDS),
    (f"<article><svg class='i'/><p>{WORDS}<svg><text>no</text></svg></article>", WORDS),
    (f"<article><math/><p>{WORDS}</article>", WORDS),
    (f"<article><title>x<p>{WORDS}", WORDS),
    (f"<script src='a'/><article><p>{WORDS}</article><script>var x = '<script>';</script>", WORDS),
    (f"<article><script>if (a < b) document.write('<script src=x><p>no</p>')</script><p>{WORDS}</article>", WORDS),
    (f"<article><video controls/><p>{WORDS}</p><video><p>no</p></video></article>", WORDS),
    (f"<article><p>{WORDS}</p><object data='x'>in its place</object></article>", WORDS + "\nin its place"),
    ("<h1>A heading</h1><p>one two three four five six seven</p><p>eight nine ten eleven twelve thirteen</p>",
     "A heading\none two three four five six seven\neight nine ten eleven twelve thirteen"),
    ("<ul><li><a href=x>one</a><li><a href=y>two</a></ul>", ""),
    ("<nav>a menu with many words that are no links at all here</nav>", ""),
])
def test_no_text_is_lost(page, kept):
    expected = "\n".join(" ".join(x.split()) for x in kept.split("\n"))
    assert html.main_text(page, TREE) == expected


@pytest.mark.parametrize("unit", [
    "<li>x", "<font>x <p>", "<b>x</i>", "<span>a</em>", "<h1>x", "<script/>x", "<title>x", "<svg/>x", "<button>x",
    "<iframe>x<p>", "<!-- x", "<a href=\"x'>y", "<div class=sidebar>x", "<svg>x", "<template>x</div>", "<noscript>x<br>"])
def test_time_is_linear(unit):
    def seconds(n):
        began = time.process_time()
        html.main_text(unit * n, TREE)
        return time.process_time() - began

    seconds(1000)
    assert seconds(200_000) < max(5, 30 * seconds(20_000))

from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
import pytest

from pluvio.llm import html, queries

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trees(spark):
    return html.fit(spark.read.parquet(f"{MIDDLE}/pages.parquet"))


def text_of(trees, page: str) -> str:
    read = html.Page(page)
    return "\n".join(read.decode(trees.probability(read.features())))


def test_given_pages(spark):
    """The article element of every given page, taken by pattern."""
    urls = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{MIDDLE}/pages.parquet").collect()}
    rows = queries.op9_main_text(spark, MIDDLE).collect()
    assert len(rows) == len(urls)
    for row in rows:
        url, page = urls[row.page_id]
        inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
        blocks = [" ".join(unescape(re.sub(r"<br>|<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert (row.url, row.text, row.n_chars) == (url, "\n".join(b for b in blocks if b), len("\n".join(b for b in blocks if b)))


def test_layouts_not_seen_in_training(trees):
    draw, right = random.Random(77), 0
    lines = [f"Sentence number {i} says a little, and then it says {i * 7} more words about nothing." for i in range(60)]
    for _ in range(100):
        page, truth = html.dressed(draw.sample(lines, draw.randint(2, 20)), lines, draw)
        read = html.Page(page)
        kept = read.decode(trees.probability(read.features()))
        right += kept == [t for (_, t, _), y in zip(read.blocks, truth) if y]
    assert right >= 95


def test_reading(trees):
    body = "<p>A first&nbsp;paragraph &amp; more,\n  long enough to be read as text.<p>A <b>second</b> one<br>follows it, just as long as the first. <!-- no --><script>var x = '<p>no</p>';</script></article>"
    assert text_of(trees, f"<html><head><title>t</title></head><body><nav><a href=x>Home</a></nav><article>{body}<footer>&copy; us</footer>") == (
        "A first paragraph & more, long enough to be read as text.\nA second one follows it, just as long as the first."
    )
    for page in ("", None, "   ", "<nav><a>x</a></nav>", "<<<>>><p", "<script>never closed", "</div></p></article>"):
        assert isinstance(text_of(trees, page), str)
    assert text_of(trees, None) == "" and text_of(trees, "<script>x") == ""


def test_choices_never_contradict(trees):
    draw = np.random.default_rng(5)
    page = html.Page("<div>" * 5 + "<p>a</p><ul><li>b<li>c</ul>" + "</div><section><p>d</p>e</section>" * 3)
    page.features()
    for _ in range(50):
        kept = page.decode(draw.random(len(page.tag)))
        assert len(kept) <= len(page.blocks)


def test_awkward_pages(spark, as_tables):
    rows = [(1, None, None), (1, "u", ""), (2, "u", "<p>" + "x " * 300_000), (None, "u", "<article><p>Some text that is long enough, one would think.</article>"), (3, "u", "\0<p>é🙂</p>")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, main_text string, text string")
    folder, _ = as_tables(pages=frame)
    found = queries.op9_main_text(spark, folder).collect()
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    assert html.extract(frame.limit(0).select("html"), html.fit(frame.limit(0))).count() == 0

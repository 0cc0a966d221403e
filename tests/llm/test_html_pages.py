"""HTML extraction: counts of copied pages, votes of tags and class words, deep trees."""

import random

import pytest

from stationcast.llm import html_extraction
from stationcast.llm.dom import parse, read


def words(k, n=30):
    rng = random.Random(k)
    return " ".join(f"w{rng.randrange(9999)}" for _ in range(n))


def extracted(spark, rows):
    return {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_counts_of_copies_do_not_change_with_host_size(spark):
    page = lambda k: f"<div><p>A notice on every page</p><p>{words(k)}</p></div>"
    rows = [(k, "http://big/", page(k if k < 20 else 0)) for k in range(700)]
    got = extracted(spark, rows)
    assert all(got[k] == words(k if k < 20 else 0) for k in got) and len(got) == 700


@pytest.mark.parametrize(
    "html",
    [
        "<div class='layout with-sidebar'><article><p>{}</p></article><div class=sidebar>more</div></div>",
        "<form id=aspnet><nav><a href=/>home</a></nav><div><p>{}</p></div><label>Name</label></form>",
        "<p>(c) us</p><form><p>{}</p></form>",
        "<main><h1>T</h1><form><p>{}</p></form></main>",
        "<div id=page-header><div id=widget><p>{}</p></div></div><footer>all rights</footer>",
    ],
)
def test_votes_do_not_empty_a_page(html):
    text = html_extraction.main_text(html.format(words(1)), set())
    assert words(1) in text and "home" not in text and "more" not in text and "rights" not in text


def test_template_goes_where_it_is_most_of_the_page(spark):
    rows = [(k, "http://t/", f"<article><p>{words(0, 80)}</p><p>{words(k)}</p></article>") for k in range(1, 9)]
    assert extracted(spark, rows) == {k: words(k) for k in range(1, 9)}


@pytest.mark.parametrize("tag", ["div", "span", "font"])
def test_deep_pages(tag):
    for deep, closed in ((1000, True), (1000, False), (30_000, True)):
        inner = f"<script>var x</script><p>{words(2)}</p><nav>home</nav><div class=ad>buy</div><{tag}>in</{tag}>"
        html = f"<article><p>{words(1)}</p>" + f"<{tag}>" * deep + inner + f"</{tag}>" * (deep * closed) + f"<p>{words(3)}</p></article><p>out</p>"
        text = html_extraction.main_text(html, set())
        assert text.split("\n\n") == [words(1), words(2), "in", words(3)]
        found, _, shape = read(parse(html))
        wrapper = html_extraction.Wrapper(shape)
        wrapper.add(html_extraction.Shape.grown(shape.flat()))
        assert {n for _, n in wrapper.counts()} == {2} and len(found) >= 6

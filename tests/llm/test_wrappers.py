"""Wrappers: the alignment decides, matching equals brute force, and time grows with the page."""

import random
import time
from functools import cache

import pytest

from stationcast.llm import dom, html_extraction
from stationcast.llm.dom import TEXT, Shape, parse, read, simple_tree_matching

from test_html_pages import extracted, words


def test_slots_of_one_path(spark):
    """Two siblings of one path: in one a text is constant, in the other the same text is content."""
    page = lambda k: f"<div><p>Our daily notice</p></div><div><p>{'Our daily notice' if k == 3 else words(k)}</p></div>"
    got = extracted(spark, [(k, "http://s/", page(k)) for k in range(1, 9)])
    assert got == {k: "Our daily notice" if k == 3 else words(k) for k in range(1, 9)}


def test_constants_are_aligned_over_lists_of_any_length(spark):
    page = lambda k: "<div>" + "".join(f"<p>{words(100 * k + i)}</p>" for i in range(k % 5 + 1)) + "<p>Read on tomorrow</p></div>"
    got = extracted(spark, [(k, "http://s/", page(k)) for k in range(200)])
    assert got == {k: "\n\n".join(words(100 * k + i) for i in range(k % 5 + 1)) for k in range(200)}


def test_without_alignment_results_differ(spark, monkeypatch):
    rows = [(k, "http://s/", f"<div><p>{words(k)}</p><p>{words(0)}</p></div>") for k in range(1, 9)]
    assert extracted(spark, rows) == {k: words(k) for k in range(1, 9)}
    monkeypatch.setattr(html_extraction, "simple_tree_matching", lambda a, b: [(a, b)])
    shape = read(parse(rows[0][2]))[2]
    wrapper = html_extraction.Wrapper(shape)
    wrapper.add(read(parse(rows[1][2]))[2])
    assert [n for _, n in wrapper.counts()] == [1] * 4


def heaviest(a, b):
    """Weight by trying every choice."""

    @cache
    def of(i, j):
        if not i or not j:
            return 0
        return max(of(i - 1, j), of(i, j - 1), of(i - 1, j - 1) + heaviest(a.children[i - 1], b.children[j - 1]))

    if a.label != b.label:
        return 0
    if a.label == TEXT:
        return 1 + (a.text == b.text)
    return 1 + of(len(a.children), len(b.children))


def some_tree(rng, depth=3):
    node = Shape(rng.choice("ab") if depth < 3 else "html")
    if depth:
        for _ in range(rng.randrange(4)):
            node.children.append(Shape(TEXT, rng.randrange(3)) if rng.random() < 0.4 else some_tree(rng, depth - 1))
    return node.seal()


def test_matching_equals_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        a, b = some_tree(rng), some_tree(rng)
        pairs = simple_tree_matching(a, b)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert sum(1 + (x.label == TEXT and x.text == y.text) for x, y in pairs) == heaviest(a, b)


@pytest.mark.parametrize(
    "html",
    ["<a b" * 250_000, "<a b" * 250_000 + ">", "<" * 1_000_000 + ">", "<a \"\" \">\" " * 90_000, "<!" * 500_000, "<!-- " * 200_000, "<script>" * 120_000, "</script " * 110_000, "<i x='>" * 140_000],
)
def test_broken_pages_of_a_megabyte(html):
    start = time.time()
    html_extraction.main_text(html)
    assert time.time() - start < 20


@pytest.mark.parametrize("text", ["same", None])
def test_very_many_siblings(text):
    pages = ["".join(f"<dt>{text or words(p + 2 * k, 2)}</dt><dd>{text or words(p + 2 * k + 7, 2)}</dd>" for k in range(25_000)) for p in (1, 2)]
    start = time.time()
    shapes = [read(parse(f"<dl>{x}</dl>"))[2] for x in pages]
    wrapper = html_extraction.Wrapper(shapes[0])
    wrapper.add(shapes[1])
    assert {n for _, n in wrapper.counts()} <= {1, 2} and time.time() - start < 40


def items(numbers):
    return "".join(f"<li><b>name {k % 5}</b><p>text {k}</p><div>Reply</div></li>" for k in numbers)


@pytest.mark.parametrize("n", [100, 200, 600])
def test_lists_of_any_length_are_matched_whole(n):
    """Items that come first on one page move the others by more than any stretch."""
    a, b = (read(parse(f"<ul>{items(x)}</ul>"))[2] for x in (range(n), [*range(-90, 0), *range(n - 5)]))
    pairs = simple_tree_matching(a, b)
    assert sum(x.label == "li" and x.key == y.key for x, y in pairs) == n - 5


def test_rows_of_long_lists_equal_those_of_short_ones(monkeypatch):
    rng = random.Random(6)
    trees = [(some_tree(rng), some_tree(rng)) for _ in range(300)]
    trees += [tuple(read(parse(f"<ul>{items(rng.sample(range(60), 40))}</ul>"))[2] for _ in range(2)) for _ in range(5)]
    found = []
    for cells, kinds, kept in ((1 << 30, 1 << 40, 1 << 30), (0, 1 << 40, 1 << 30), (0, 0, 0), (1 << 30, 0, 20)):
        for name, value in (("CELLS", cells), ("ALL_CELLS", kinds), ("KEPT_CELLS", kept)):
            monkeypatch.setattr(dom, name, value)
        found.append([{(id(x), id(y)) for x, y in simple_tree_matching(a, b)} for a, b in trees])
    assert all(x == found[0] for x in found)
    assert all(sum(1 + (x.label == TEXT and x.text == y.text) for x, y in simple_tree_matching(a, b)) == heaviest(a, b) for a, b in trees[:300])


def test_constants_of_long_lists(spark):
    """A notice below a list whose length varies is template on all pages, however many items there are."""
    page = lambda k: "<div>" + "".join(f"<p>{words(1000 * k + i, 5)}</p>" for i in range(130 + 9 * k)) + "<p>Read on tomorrow</p><p>" + words(k, 4) + "</p></div>"
    got = extracted(spark, [(k, "http://s/", page(k)) for k in range(1, 9)])
    assert not any("Read on tomorrow" in x for x in got.values()) and all(got[k].endswith(words(k, 4)) for k in got)

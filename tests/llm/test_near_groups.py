"""Groups of near copies that are not near enough form few candidate pairs, and lose no link."""

import random

import pytest

from stationcast.llm import line_dedup, ngram_join


def copies(rng, words, changed, number):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(number):
        own = list(base)
        for at in rng.sample(range(words), changed):
            own[at] = f"w{rng.randrange(10**6)}"
        out.append(own)
    return out


def grams(words, n):
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


@pytest.fixture
def counted(monkeypatch):
    def count(module, name):
        pairs, plain = [], getattr(module, name)

        def counting(found, *rest):
            pairs.append(found.select("a", "b").distinct().count())
            return plain(found, *rest)

        monkeypatch.setattr(module, name, counting)
        return pairs

    return count


def test_documents(spark, counted):
    rng = random.Random(7)
    texts = copies(rng, 150, 4, 60) + copies(rng, 150, 1, 12)
    pairs = counted(ngram_join, "overlaps")
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(rows).collect()}
    sets, root = [grams(t, 4) for t in texts], list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if 100 * len(x & y) >= 85 * len(x | y):
                    root[a] = min(root[a], root[b])
    assert got == dict(enumerate(root)) and len(set(root)) < len(texts)
    assert sum(pairs) < 300, pairs


def test_lines(spark, counted):
    rng = random.Random(8)
    lines = copies(rng, 30, 1, 60) + copies(rng, 90, 1, 12)
    pairs = counted(line_dedup, "similar")
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.without_lines(rows).collect()}
    sets = [grams(t, 5) for t in lines]
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    assert got == {k: int(any(near(x, y) for y in sets[:k])) for k, x in enumerate(sets)} and sum(got.values())
    assert sum(pairs) < 300, pairs


def test_membership_filters_shuffle_no_text(spark):
    keys = line_dedup.members(spark.range(100), "id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = line_dedup.with_maybe(spark.range(9), keys, "told", "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan

"""Line deduplication: before pairs are formed, only a part of a line's tokens is hashed, and only lines that are looked at are cleaned."""

import random
import re

from stationcast.llm import line_dedup


def grams(words):
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def lines():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(40)]
    found = [["a"], ["a", "b", "c", "d"], ["x"] * 30, ["x"] * 31, ["x", "y"] * 20, ["x", "y"] * 21]
    for _ in range(60):
        line = rng.choices(words, k=rng.randint(5, 80))
        found.append(line)
        for _ in range(2):
            near = list(line)
            near[rng.randrange(len(near))] = rng.choice(words)
            found.append([*near, *rng.choices(words, k=rng.randint(0, 3))][rng.randint(0, 2) :])
    return found


def test_similar_lines_share_as_many_tokens_as_needed(spark):
    texts = lines()
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in line_dedup.with_least(line_dedup.plain_lines(rows), 80).collect()}
    sets, some = [grams(t) for t in texts], 0
    for a in range(len(texts)):
        for b in range(a):
            if len(texts[a]) >= 5 <= len(texts[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                shared = len(set(found[a].least) & set(found[b].least))
                assert shared >= max(found[a].need, found[b].need), (texts[a], texts[b])
                some += 1
    assert some > 40 and not found[0].least and not found[1].least


def test_few_tokens_of_a_line_are_hashed(spark):
    words = [f"w{k}" for k in range(204)]
    rows = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = line_dedup.with_least(line_dedup.plain_lines(rows), 80).first()
    assert len(got.least) == 51 and got.need == 9


def test_lines_equal_those_of_all_pairs(spark):
    texts = lines()
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    sets = [grams(t) for t in texts]
    near = lambda x, y: 100 * len(x & y) >= 80 * len(x | y)
    want = {k: int(any(near(x, y) for y in sets[:k])) for k, x in enumerate(sets)}
    assert {r.doc_id: r.n_removed for r in line_dedup.without_lines(rows).collect()} == want and sum(want.values()) > 20


def test_words_are_sorted_and_hashed_outside_of_functions(spark):
    rows = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    plan = line_dedup.with_least(line_dedup.plain_lines(rows), 80)._jdf.queryExecution().optimizedPlan().toString()
    inside = re.findall(r"lambdafunction\(([^\n]*?)\)", plan)
    assert inside and not any("sort_array(" in x or "split(" in x for x in inside), inside

"""The pipeline's near-copy stage against brute force, on null and repeated doc_ids."""

import random

import corpus_pipeline


def grams(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()}


def test_near_copies_are_decided_row_by_row(spark):
    rng = random.Random(3)
    some = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    a, b, c, d = (some() for _ in range(4))
    rows = [(1, a), (1, b), (1, a), (None, c), (None, some()), (None, some()), (None, c + " end"), (None, a + " end"), (None, None), (None, "")]
    rows += [(2, some()), (2, b + " end"), (2, d), (3, d + " end"), (3, some()), (4, "one two"), (4, "one  two"), (5, None), (5, None), (6, ""), (None, "")]
    docs = spark.createDataFrame([(k, t, "en") for k, t in rows], "doc_id long, text string, lang string")
    kept = corpus_pipeline.distinct_documents(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got))
    whole = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    sets = [grams(t) for _, t in whole]
    root = list(range(len(whole)))
    for _ in whole:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    root[i] = min(root[i], root[j])
    groups = {}
    for k, r in enumerate(root):
        groups.setdefault(r, []).append(whole[k])
    for members in groups.values():
        survivors = [r for r in got if r in members]
        # Of different texts under the least doc_id, any one may stay.
        assert len(survivors) == 1 and survivors[0][0] == members[0][0], members
    assert len(got) == len(groups)

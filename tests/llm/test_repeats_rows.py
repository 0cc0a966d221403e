"""Repeats among thousands of different texts without a doc_id."""

import random

import numpy as np

from stationcast.llm import repeats


def test_texts_that_share_a_doc_id_keep_their_own_ranges(spark):
    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passages = [some(130) for _ in range(40)]
    texts = [some(rng.randrange(150)) + rng.choice(passages) + some(rng.randrange(150)) for _ in range(2500)] + [some(300) for _ in range(1500)]
    first = {}
    for text in texts:
        for i in range(len(text) - 99):
            first[text[i : i + 100]] = min(i, first.get(text[i : i + 100], i))
    want = set()
    for text in texts:
        cover = np.zeros(len(text), bool)
        for i in range(len(text) - 99):
            if first[text[i : i + 100]] < i:
                cover[i : i + 100] = True
        want.add((len(text), int(cover.sum()), bytes(np.frombuffer(text.encode(), np.uint8)[~cover])))
    rows = repeats.without_repeats(spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")).collect()
    assert len(rows) == len(texts) and {(r.n_bytes, r.n_removed, bytes(r.kept)) for r in rows} == want

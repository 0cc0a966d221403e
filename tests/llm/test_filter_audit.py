"""The filter audit against a plain recount, with nulls, repeats, long texts and extra columns."""

import re
from collections import Counter
from itertools import permutations

from stationcast.llm.filter_audit import COUNTS, audit

SCHEMA = "doc_id long, text string, source string, mask int, n long, part string"
WORDS = " ".join(f"w{i}" for i in range(300))
ROWS = [
    (1, WORDS, "a"), (2, WORDS, "a"), (2, WORDS, "a"), (2, WORDS, None), (3, WORDS + " #", "b"), (4, None, None), (5, "", "a"),
    (None, WORDS, "a"), (None, WORDS, "b"), (None, None, "b"), (6, "x " * 250, "a"), (7, "X Y Z " * 40, "a"), (8, "É\x0bÉ é " * 90, ""),
    (9, "Word word\t" * 60_000, "b"), (10, "Word word\t" * 60_000, "a"), (11, "a|b", "a"), (12, " \n\r", "a"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, 1, 1), (99, 1, 1), (None, 1, 1), (7, None, None), (9, 0, 1)]


def recount(rows, labels):
    def fails(doc_id, text):
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        found = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        found += "C" * (100 * len(re.findall("[A-Z]", text)) > 2 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        return found + "E" * (doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows))

    documents = [(s or "", fails(i, t or ""), any(x[0] == i and i is not None and x[1] == 1 for x in labels), any(x[0] == i and i is not None and x[2] == 1 for x in labels)) for i, t, s in rows]
    out = {}
    for part in {d[0] for d in documents}:
        removed = Counter()
        for order in permutations("ABCDE"):
            left = [d for d in documents if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in d[1]]
                left, redundant = [d for d in left if f not in d[1]], [d for d in gone if f in d[1]]
                gone += here
                removed[f] += len(here)
                only = [d for d in documents if d[0] == part and d[1] == f]
                out[part, "".join(order), step] = [len(left), len(here), len(redundant), len(only), sum(d[2] for d in here), sum(d[3] for d in here), f]
        for key, row in out.items():
            if key[0] == part:
                row[-1] = removed[row[-1]]
    return out


def test_audit_equals_a_recount(spark):
    documents = spark.createDataFrame([(*r, 7, 8, "other") for r in ROWS], SCHEMA).repartition(4)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = audit(documents, labels).collect()
    want = recount(ROWS, LABELS)
    assert len(found) == len(want) == 3 * 600
    assert {(r.part, r.filter_order, r.step): [*(r[c] for c in COUNTS), r.shapley] for r in found} == want


def test_own_conditions(spark):
    documents = spark.createDataFrame([(i, "a b c"[: i % 6], "s") for i in range(30)], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = audit(documents, labels, {"s": "n_words < 2", "t": "n_points > 4"}).collect()
    assert {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in rows} == {
        ("st", 1): (15, 15, 0, 30), ("st", 2): (10, 5, 0, 10), ("ts", 1): (25, 5, 0, 10), ("ts", 2): (10, 15, 0, 30),
    }


def test_empty_tables(spark):
    documents = spark.createDataFrame([], SCHEMA)
    assert audit(documents, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0

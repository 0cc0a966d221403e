"""The operators against brute force on small tables with nulls, empties, ties, repeats and odd columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stationcast.llm import decontamination, html_extraction, language, licenses, line_dedup, ngram_join, packing, repeats, search, sharding

random.seed(5)
VOCABULARY = ["alpha", "beta", "gamma", "delta", "eins", "zwei", "drei", "rouge", "vert", "bleu", "uno", "dos", "tres", "ñu", "x1"]


def sentence(n):
    return " ".join(random.choice(VOCABULARY) for _ in range(n))


BASE = sentence(120)
TEXTS = [
    BASE, BASE, BASE + " end", BASE.replace("alpha", "ALPHA", 1), None, "", " \n\t ", "one", "one two", "One two", "\n\n",
    sentence(40) + "\n" + BASE[:300] + "\n" + sentence(9), BASE[:300] + "\nunder the MIT license, under the mit-license\n" + sentence(9),
    "Released under the MIT License.\nApache License, Version 2.0.", sentence(3000), "aaaa" * 200, "a" * 99, "日本 語 text é" * 30,
]


def frame(spark, texts=TEXTS):
    rows = [(k, t, "en" if k % 2 else "de", "n", k) for k, t in enumerate(texts)] + [(None, BASE, None, "n", 1), (0, TEXTS[0], "de", "n", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, spans string, size int")


def empty(spark):
    return frame(spark).where("false")


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = packing.packed(frame(spark)).collect()
    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    lengths = {k: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for k, t in enumerate(TEXTS)}
    sums = Counter()
    for r in rows:
        if r.doc_id is not None:
            sums[r.doc_id] += r.length
        assert 1 <= r.length <= 1024 and (r.piece == 0 or r.length == 1024)
    assert sums == {k: n * (2 if k == 0 else 1) for k, n in lengths.items()}
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_configurations_use_each_piece_once_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    histogram = np.bincount(rng.integers(1, 1025, size=2000), minlength=1025)
    plan = packing.configurations(histogram, 1024)
    used = Counter()
    for counts, times in plan:
        assert sum(n * k for n, k in counts.items()) <= 1024
        for n, k in counts.items():
            used[n] += k * times
    assert used == {n: k for n, k in enumerate(histogram) if k}
    assert sum(times for _, times in plan) <= 1.02 * (histogram * np.arange(1025)).sum() / 1024 + 1


def test_html(spark):
    nav = "<nav><a href=/>home</a></nav><div class='ad'>buy</div>"
    html = f"<html><body>{nav}<article><h1>T &amp; u</h1><p>a\n  <b>b<br>c<p>d<script>x</script></article><div id=comments>no</div><footer>f</footer>"
    rows = [(1, "http://h/1", html, 1), (2, "http://h/2", None, 1), (3, None, "", 1), (4, "x", "plain &lt;text", 1), (4, "x", "plain &lt;text", 1)]
    rows += [(10 + k, f"http://t/{k}", f"<div><p>Subscribe now</p><p>{sentence(30)}</p></div>", 1) for k in range(8)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r.text for r in html_extraction.extract(pages).collect()}
    assert got[1] == "T & u\n\na b c\n\nd" and got[2] == "" and got[3] == "" and got[4] == "plain <text"
    assert all("Subscribe" not in got[10 + k] and got[10 + k] for k in range(8))  # constant among varying pages
    assert html_extraction.extract(pages).count() == len(rows)
    assert html_extraction.extract(pages.where("false")).count() == 0


def shingles(text, n=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def test_ngram_join(spark):
    texts = [*TEXTS, *(" ".join(w for k, w in enumerate(BASE.split()) if k != j) for j in range(0, 100, 7))]
    rows = [(k, shingles(t)) for k, t in enumerate(texts)]
    root = {k: k for k, _ in rows}
    for _ in rows:
        for a, x in rows:
            for b, y in rows:
                if x and 100 * len(x & y) >= 85 * len(x | y):
                    root[a] = min(root[a], root[b])
    got = ngram_join.jaccard_components(frame(spark, texts)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == {(k, len(x), root[k]) for k, x in rows}
    assert len(got) == len(texts) + 2 and ngram_join.jaccard_components(empty(spark)).count() == 0


def test_licenses(spark):
    got = {r.doc_id: r for r in licenses.licenses(frame(spark)).collect()}
    assert (got[12].n_base, got[12].base_labels, got[12].labels) == (2, "mit", "mit")
    assert got[12].last_word - got[12].first_word == 4
    assert got[13].labels == "apache-2,mit" and got[13].score == 1.0 and got[13].first_word == 1
    assert got[4].n_words == 0 and got[4].first_word is None and got[5].labels == ""
    assert licenses.licenses(empty(spark)).count() == 0


def test_line_dedup(spark):
    got = line_dedup.without_lines(frame(spark)).collect()
    assert len(got) == len(TEXTS) + 2
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    # The row without a doc_id comes first, so the equal line of 0 goes, and near ones after it.
    assert by[0].n_removed == 1 and by[1].n_removed == 1 and by[2].n_removed == 1
    assert by[4].text is None and by[5].text == "" and by[6].n_removed == 0 and by[10].text == "\n\n"
    assert by[8].text == "one two" and by[9].n_removed == 1 and by[0].spans == "n"
    assert line_dedup.without_lines(empty(spark)).count() == 0


def test_language(spark):
    rows = [(k, sentence(30) if k % 2 else "the cat sat on a mat near the hat " * 3, "xx" if k % 2 else "en") for k in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(train)
    got = {r.doc_id: r._language for r in language.identify(frame(spark), model, ["doc_id", "spans"]).collect()}
    assert got[4].lang_pred == got[5].lang_pred == got[6].lang_pred == "und" and got[0].lang_pred == "xx"
    held = {r.doc_id: r._language.lang_pred for r in language.identify(train, model, ["doc_id"]).collect()}
    assert sum(held[k] == lang for k, _, lang in rows) >= 198
    nothing = language.fit(empty(spark))
    assert {r._language.lang_pred for r in language.identify(frame(spark), nothing, ["doc_id"]).collect()} == {"und"}


def test_search(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, size=5) / 4], 0) for k in range(90)]
    rows += [(200, None, 0), (201, [1.0, None, 0.0, 0.0, 0.0], 0), (202, [float("nan")] * 5, 0), (203, rows[3][1], 0), (204, rows[3][1], 0)]
    vectors = search.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int"))
    got = search.top_k(vectors.where("id % 20 = 0"), vectors, 20, query_block=2, shard_block=16).collect()
    whole = {k: [np.floor(64 * x) for x in v] for k, v, _ in rows if v and None not in v and not np.isnan(v).any()}
    want = set()
    for q in [k for k in whole if k % 20 == 0]:
        best = sorted((-int(np.dot(whole[q], whole[c])), c) for c in whole if c != q)[:20]
        want |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    assert {tuple(r) for r in got} == want
    assert search.top_k(vectors.where("false"), vectors, 20).count() == 0


def test_decontamination(spark):
    words = BASE.split()
    items = [(1, " ".join(words[5:30])), (2, "one"), (3, None), (4, "..."), (5, " ".join(words[60:72])), (5, "nowhere at all to be found in any of these texts")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block in (decontamination.BLOCK_WORDS, 20):
        found = decontamination.matches(frame(spark), benchmark, ["doc_id"], block_words=block).collect()
        by = {r.doc_id: r._found for r in found}
        assert {x.item_id for x in by[0]["items"]} >= {"1", "5"} and {x.item_id for x in by[7]["items"]} == {"2"}
        assert sum(s.length for s in by[0].spans) >= 37 and by[4].n_words == 0 and not by[15].spans
    kept = decontamination.clean(frame(spark), benchmark)
    assert kept.columns == frame(spark).columns and kept.where("doc_id = 0").count() == 0 and kept.where("doc_id = 15").count() == 1
    assert decontamination.contamination(empty(spark), benchmark).count() == 0
    assert decontamination.contamination(frame(spark), benchmark.where("false")).where("contaminated").count() == 0


def test_sharding(spark):
    texts = [*TEXTS, *["same text"] * 400, *(sentence(k % 50) for k in range(300))]
    got = sharding.shards(frame(spark, texts), sharding.text_key(), line_dedup.F.expr("coalesce(octet_length(text), 0) + 1L")).collect()
    sizes, slots = Counter(), {}
    for r in got:
        sizes[r.shard] += len((r.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
    mean = sum(sizes.values()) / 8
    assert len(got) == len(texts) + 2 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(abs(n - mean) <= 2 * max(len((t or "").encode()) for t in texts) for n in sizes.values())
    assert sharding.shards(empty(spark), sharding.text_key(), line_dedup.F.lit(1)).count() == 0


def test_repeats(spark):
    passage = sentence(60)
    texts = [*TEXTS, passage + " tail", "head " + passage, sentence(30) + passage + sentence(30) + passage]
    seen, want = set(), {}
    own = sorted([(-1, BASE), *enumerate(texts)])
    for k, text in [(k, (t or "").encode()) for k, t in own]:
        cover = np.zeros(len(text), bool)
        for i in range(len(text) - 99):
            if text[i : i + 100] in seen:
                cover[i : i + 100] = True
            seen.add(text[i : i + 100])
        kept = bytes(np.frombuffer(text, np.uint8)[~cover])
        want[k] = (len(text), int(cover.sum()), hashlib.sha256(kept).hexdigest())
    rows = repeats.without_repeats(frame(spark, texts)).collect()
    got = {-1 if r.doc_id is None else r.doc_id: (r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in rows}
    assert len(rows) == len(texts) + 2 and got == want
    assert repeats.without_repeats(empty(spark)).count() == 0


def test_line_filters_are_tables(spark):
    """Plans, which the driver keeps as text, don't hold the filters."""
    found = line_dedup.without_lines(frame(spark))
    assert len(found._jdf.queryExecution().toString()) < 40_000
    keys = spark.range(1000).select("id")
    told = line_dedup.with_maybe(spark.range(20_000), line_dedup.members(keys, "id"), "told", "id").where("told")
    assert told.where("id < 1000").count() == 1000 and told.count() < 6000
    assert line_dedup.with_maybe(spark.range(9), line_dedup.members(keys.limit(0), "id"), "told", "id").where("not told").count() == 9

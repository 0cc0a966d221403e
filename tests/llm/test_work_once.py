"""Line deduplication: texts are split once, lines are cleaned by bytes, and tokens are runs of five words."""

import re

from stationcast.llm import line_dedup

LONG = "\n".join(f"one two three four five six {k}" for k in range(40))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_is_not_split_again_for_each_of_its_lines(spark):
    rows = spark.createDataFrame([(1, LONG + "\n" + LONG), (2, "a\tb  c\n" + LONG)], "doc_id long, text string")
    found = line_dedup.without_lines(rows)
    inside = re.findall(r"lambdafunction\(([^\n]*?)\)", plan(found))
    assert inside and not any("split(" in x for x in inside), inside
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in found.collect()} == {1: (80, 40, LONG), 2: (41, 40, "a\tb  c")}


def test_lines_are_cleaned_without_counting_characters(spark):
    rows = spark.createDataFrame([(1, "A\tb  \x0bc \n \r\f\nd é  É"), (2, None), (3, "")], "doc_id long, text string")
    found = line_dedup.plain_lines(rows)
    assert "instr(" not in plan(found)
    assert sorted((r.doc_id, r.line, r.s) for r in found.collect()) == [(1, 0, "a b c"), (1, 2, "d é é")]


def test_tokens_are_the_distinct_runs_of_five_words(spark):
    lines = ["a", "a b c d", "a b c d e", "a b c d e f", "a a a a a a a", "a b c d e a b c d e"]
    rows = spark.createDataFrame([(k, s) for k, s in enumerate(lines)], "doc_id long, text string")
    found = {r.doc_id: r.t for r in line_dedup.with_tokens(line_dedup.plain_lines(rows)).collect()}
    assert [len(found[k]) for k in range(6)] == [1, 1, 1, 2, 1, 5]
    assert found[2][0] == found[3][0] == found[5][0]
    assert len({x for t in found.values() for x in t}) == 9

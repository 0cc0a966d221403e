"""License notices that are wrapped over several lines, as license files have them."""

import textwrap

from stationcast.llm import licenses


def test_wrapped_notices(spark):
    rows, want = [], {}
    for k, (text, label) in enumerate(licenses.TEMPLATES):
        for j, (width, prefix, before) in enumerate(((30, "", 0), (72, "# ", 7), (40, " * ", 400), (1, "", 3))):
            doc = f"{prefix}\n" + textwrap.fill("word " * before + text, width, initial_indent=prefix, subsequent_indent=prefix, break_long_words=False)
            rows.append((10 * k + j, f"x y\n\n{doc}\r\n{prefix}\nz"))
            want[10 * k + j] = label
    # Half of a notice in each of two paragraphs is none; neither are its words far from each other.
    half = licenses.TEMPLATES[1][0].split()
    rows += [(900, " ".join(half[:10]) + "\n \n" + " ".join(half[10:])), (901, "\n".join(half[:10]) + "\nword" * 200 + "\n" + "\n".join(half[10:]))]
    got = {r.doc_id: r for r in licenses.licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) and all(label in got[k].labels.split(",") and got[k].score == 1.0 for k, label in want.items())
    assert got[900].labels == got[901].labels == ""

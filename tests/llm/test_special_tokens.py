"""Ids of texts that hold added tokens, and of texts that are encoded in parts, against the library."""

import numpy as np
import public_tokenizers
from stationcast.llm import packing
from tokenizers import Tokenizer


def test_ids_are_the_librarys(spark):
    files = [str(public_tokenizers.path(f"byte_bpe_50k.{kind}")) for kind in ("json", "tiktoken")]
    library = Tokenizer.from_file(files[0])
    end = "<|endoftext|>"
    filler = "ab cd " * (packing.PART // 6 + 9)
    texts = [
        f"a {end} b", end, end * 3, f"a{end}b  {end}\n{end} c", "<|endoftext |> <|endoftext|", filler + f"{end} x  {end}",
        f"{'a' * packing.PART}  {end} b c", (f"{end} some  " * (packing.PART // 10)), "é " * packing.PART, *(f"{k} {end}" for k in range(5)),
    ]
    for place in range(14):  # the cut falls on every place around the token
        texts.append("x" * (packing.PART - place) + f" y  {end}  z w")
    rows = packing.tokenize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), *files).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    for k, text in enumerate(texts):
        assert got[k] == [*library.encode(text, add_special_tokens=False).ids, packing.END_ID], text[:50]

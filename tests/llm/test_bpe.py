import hashlib

import numpy as np
import public_tokenizers
import pytest

from goldrec.llm import bpe
from goldrec.llm.queries import RANKS
from llm.conftest import LONG, found


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (50, 16), (7, 3)])
def test_equals_the_library(documents, odd, chunk, overlap):
    rows = documents.where("doc_id < 25").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    encoding = bpe._encoding(RANKS, public_tokenizers.PATTERN)
    wanted = sorted((str(r["doc_id"]), np.array(encoding.encode_ordinary(r["text"] or ""), "<u4").tobytes(), (r["text"] or "").encode()) for r in rows.collect())
    got = bpe.decode(bpe.encode(rows, RANKS, public_tokenizers.PATTERN, chunk, overlap), RANKS)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in got.collect())
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in got.collect()) == wanted


@pytest.mark.parametrize("text", ["a\n\n b  c" * 40, " " * 300, "x" * 300 + " y", "it's we'll\t\t " * 30, "a" + "\n" * 80 + "b", "漢" * 200 + "é 🙂" * 50])
def test_stitches_hard_texts(spark, text):
    encoding = bpe._encoding(RANKS, public_tokenizers.PATTERN)
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    for chunk, overlap in ((20, 6), (33, 12)):
        r = bpe.encode(rows, RANKS, public_tokenizers.PATTERN, chunk, overlap).first()
        assert np.frombuffer(r["ids"], "<u4").tolist() == encoding.encode_ordinary(text)


def test_boundaries_stand_after_non_blanks():
    found_ = bpe.boundaries(LONG[44_000:50_000], 0, public_tokenizers.PATTERN, False)
    assert found_ and all(not LONG[44_000 + x - 1].isspace() for x in found_)


def test_digests_and_odd_rows(odd, clashing, empty):
    rows = found(bpe.token_digests(odd, RANKS, public_tokenizers.PATTERN))
    assert len(rows) == 13 and all(r[1] == 0 for r in rows if r[0] in (1, 2))
    assert rows[0][3] == hashlib.sha256(b"").hexdigest()
    assert found(bpe.token_digests(clashing, RANKS, public_tokenizers.PATTERN)) == rows
    assert bpe.token_digests(empty, RANKS, public_tokenizers.PATTERN).collect() == []

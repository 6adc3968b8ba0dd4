import hashlib

import numpy as np
import pyarrow as pa
import pytest

from goldrec.llm import suffix
from llm.conftest import found


def brute(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            else:
                seen.add(b[s:s + length])
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("piece,crowd", [(1 << 20, 4096), (3_000, 2)])
def test_equals_brute_force(documents, monkeypatch, piece, crowd):
    monkeypatch.setattr(suffix, "CROWD", crowd)
    docs = documents.select("doc_id", "text")
    from pyspark.sql import functions as F

    got = suffix.without_repeats(docs, most=piece).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert sorted(map(tuple, got.collect())) == brute([tuple(r) for r in docs.collect()])


def test_edges_of_a_repeat(spark):
    a = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(300))
    texts = [a, a[:99], a[:100], "q" + a[50:150] + "r", a[50:149] + "zz", "é" * 49 + "ab" + a[10:120], "x" * 450, "xyz" * 99, "é" * 50 + a[200:], a + a,
             a[20:140] + "-" + a[130:260], a]
    rows = list(enumerate(texts))
    for piece in (1 << 20, 120):
        from pyspark.sql import functions as F

        got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), most=piece)
        assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())) == brute(rows)


def test_odd_rows(odd, clashing, empty):
    rows = found(suffix.repeat_report(odd))
    assert len(rows) == 13
    by = {r[0]: r for r in rows if r[0] is not None}
    assert by[1][1:4] == (0, 0, 0) and by[4][2] == 0 and by[5][2] == by[5][1] and by[6][2] == by[4][1]
    assert found(suffix.repeat_report(clashing)) == rows
    assert suffix.repeat_report(empty).collect() == []


def test_documents_with_what_stays(odd, clashing):
    left = {r["doc_id"]: r for r in suffix.deduplicated(odd).collect()}
    assert left[6]["text"] == " but not quite" and left[6]["n_chars"] == 14 and left[5]["text"] == ""
    assert suffix.deduplicated(clashing).columns == clashing.columns


def test_covers_that_agree_in_31_bits_only(spark):
    """Of 200,000 texts of 100 bytes around one k-gram, two whose cover hashes begin alike: nothing repeats."""
    rng = np.random.default_rng(0)
    lines = rng.integers(97, 123, (100_000, 24), np.uint8)
    gram = suffix.Strings(lines.ravel(), np.arange(0, lines.size + 1, lines.size), 100).gram[::24]
    line = lines[np.argmin(gram)].tobytes()  # is the anchor of nearly every string it is in
    seen, pair = {}, None
    for _ in range(40):
        texts = [line + rest.tobytes() for rest in rng.integers(97, 123, (10_000, 76), np.uint8)]
        for piece in suffix.pieces(pa.array([x.decode() for x in texts]), 100, 1 << 20):
            for h, c, i in zip(piece.h.tolist(), (piece.c >> suffix.U(33)).tolist(), piece.text.tolist()):
                if pair is None and (h, c) in seen:
                    pair = (seen[h, c], texts[i].decode())
                seen[h, c] = texts[i].decode()
        if pair:
            break
    others = [x.tobytes().decode() for x in rng.integers(97, 123, (200, 100), np.uint8)]  # so that both are in one range
    rows = list(enumerate([*pair, *others]))
    got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_removed").collect()
    assert pair[0] != pair[1] and sorted(map(tuple, got)) == [(i, 0) for i in range(len(rows))]


@pytest.mark.parametrize("id_", [None, 9])
@pytest.mark.parametrize("crowd", [4096, 2])
def test_texts_that_share_an_id(spark, monkeypatch, id_, crowd):
    """Two long texts of one id or none, which repeat earlier passages at different places, and a third that only its like has."""
    monkeypatch.setattr(suffix, "CROWD", crowd)
    rng = np.random.default_rng(0)
    a, b, c, d = ("".join(rng.choice(list("abcdefghijklmnop "), 400)) for _ in range(4))
    texts = [c[:150] + a[100:300], d + "-" + b[50:390] + c[:20], "q" + b[60:180] + "r" + d, d[:250], a[3:140]]
    rows = [(1, a), (2, b), *((id_, t) for t in texts)]
    got = suffix.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("text", "n_removed", "kept").collect()
    assert len(got) == len(rows)
    earlier = {x[i:i + 100] for x in (a, b) for i in range(301)}
    for r in got:
        gone = [False] * len(r["text"])
        for i in range(len(r["text"]) - 99):
            if r["text"][i:i + 100] in earlier and r["text"] not in (a, b):
                gone[i:i + 100] = [True] * 100
        assert r["n_removed"] == sum(gone) and bytes(r["kept"]).decode() == "".join(x for x, g in zip(r["text"], gone) if not g)

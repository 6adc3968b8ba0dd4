import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from goldrec.llm import alignment
from goldrec.llm.queries import BYTE_LEVEL, PIECES
from llm.conftest import CLASHING, LONG, found

ARGS = (BYTE_LEVEL, PIECES, P.PATTERN)
HARD = ["a<|endoftext|>b <s> </s> <0x41> <unk>", "▁x", " lead", "tab\t\n\n  end  ", "x\u0085y z w", "é漢🙂 ﬁ Å ½²", "﻿b", "a\0b", "it's we'LL 123 4567", "ǅ ʰ ʻokina ßß", " " * 40 + "x"]


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(BYTE_LEVEL)
    tokenizer.encode_special_tokens = True
    letters = alignment._byte_letters()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def both(text):
        """Ids and bytes of either library over the whole text; nothing where they don't spell it."""
        if not text:
            return [], [], [], []
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        wa = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        b = model.encode(text)
        wb = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(model.id_to_piece, b))]
        whole = (" " + text).encode()
        return (a, wa, b, wb) if b"".join(wa) == whole == b"".join(wb) else ([], [], [], [])
    return both


def brute_rows(texts, both):
    groups, links, counts = [], [], Counter()
    for text in texts:
        a, wa, b, wb = both(text)
        ends_a, ends_b = np.cumsum([len(w) for w in wa]).tolist(), np.cumsum([len(w) for w in wb]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        written, linked, x, y = [], [], 0, 0
        for e in common:
            i, j = ends_a.index(e) + 1, ends_b.index(e) + 1
            written.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            linked.append((a[i - 1], b[j - 1]))
            x, y = i, j
        counts.update(linked)
        groups.append((len(a), len(b), len(common), ";".join(written)))
        links.append(linked)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(n_a, n_b, n, len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), hashlib.sha256(g.encode()).hexdigest() if g else "")
            for (n_a, n_b, n, g), ls in zip(groups, links)]


@pytest.mark.parametrize("piece", [alignment.PIECE, 200])
def test_equals_brute_force(spark, documents, odd, libraries, monkeypatch, piece):
    monkeypatch.setattr(alignment, "PIECE", piece)
    rows = documents.where("doc_id < 60").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = rows.unionByName(spark.createDataFrame(list(enumerate(HARD, 1_000)), "doc_id long, text string"))
    held = rows.collect()
    want = [(r["doc_id"], *x) for r, x in zip(held, brute_rows([r["text"] for r in held], libraries))]
    # tasks run in other processes: the pieces are cut in this one, too
    got = found(alignment.alignment_digests(rows, *ARGS).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
    assert got == sorted(want, key=lambda r: [(x is None, str(x)) for x in r])
    pair = alignment.tokenizers(*ARGS)
    for texts in ([r["text"] for r in held], [LONG], [None, ""]):
        s = alignment.Slice(texts, pair)
        for i, text in enumerate(texts):
            a, _, b, _ = libraries(text)
            assert s.a[s.from_a[i]:s.from_a[i + 1]].tolist() == a and s.b[s.from_b[i]:s.from_b[i + 1]].tolist() == b


def test_gallop_and_overlaps():
    rng = random.Random(3)
    for _ in range(300):
        end = rng.randint(1, 400)
        a, b = (np.array(sorted({*rng.sample(range(1, end + 1), rng.randint(0, min(end, rng.choice([3, 200])))), end})) for _ in range(2))
        assert alignment.gallop(a, b).tolist() == [int((b < x).sum()) for x in a]
        i, j = alignment.common_ends(a, b)
        assert a[i].tolist() == b[j].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        first, last = alignment.overlaps(a, b)
        for n, e in enumerate(a):
            start = a[n - 1] if n else 0
            over = [k for k in range(len(b)) if b[k] > start and (b[k - 1] if k else 0) < e]
            assert (first[n], last[n]) == (over[0], over[-1])


def test_aligned_groups_spell_the_same(odd):
    pair = alignment.tokenizers(*ARGS)
    for r in alignment.align(odd, *ARGS).collect():
        x = y = 0
        for i, j in zip(r["a_until"], r["b_until"]):
            assert b"".join(pair.bytes_a[t] for t in r["a"][x:i]) == b"".join(pair.bytes_b[t] for t in r["b"][y:j])
            x, y = i, j
        assert (x, y) == (len(r["a"]), len(r["b"])) and len(r["b_first"]) == len(r["a"])
        assert all(0 <= f <= n < len(r["b"]) for f, n in zip(r["b_first"], r["b_last"]))


def test_the_faster_library_gives_the_same_ids(documents):
    pair = alignment.tokenizers(*ARGS)
    texts = [" " + r["text"] for r in documents.collect()] + [" " + t for t in HARD]
    assert pair.encoding and pair.cuts
    assert pair.encode_a(texts) == [pair._encode(t) for t in texts]


def test_odd_rows(odd, clashing, empty):
    rows = found(alignment.alignment_digests(odd, *ARGS))
    assert len(rows) == 13 and all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in rows if r[0] in (1, 2))
    assert len({r[1:] for r in rows if r[0] in (4, 5)}) == 1
    assert found(alignment.alignment_digests(clashing, *ARGS)) == rows
    assert alignment.alignment_digests(empty, *ARGS).collect() == [] == alignment.align(empty, *ARGS).collect()
    assert set(CLASHING) <= set(clashing.columns)

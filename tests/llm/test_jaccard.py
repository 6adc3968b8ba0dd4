import re
from collections import Counter

import numpy as np
import pytest

from goldrec.llm import jaccard
from goldrec.llm.components import components
from llm.conftest import found

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    places = {}
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in places.get(s, ()))
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for s in sets[i]:
            places.setdefault(s, []).append(i)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize("large,block,often", [(64, 512, 3), (2, 3, 2)])
def test_equals_brute_force(spark, sf, monkeypatch, large, block, often):
    monkeypatch.setattr(jaccard, "LARGE", large)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "OFTEN", often)
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect())) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_a_family_of_near_copies(spark):
    """Copies with more and more words changed, and some far from all: links at the very limit."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    texts = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(60, size=i % 5, replace=False):
            words[k] = f"x{rng.integers(10**6)}"
        texts.append((i, " ".join(words)))
    texts += [(1000 + i, " ".join(base[:n])) for i, n in enumerate((4, 5, 6, 48, 49, 50))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect())) == brute(texts)


def test_hash_order_and_leading_part():
    for n in range(1, 200):
        size = jaccard.leading_size(n)
        # a linked set shares at least 80 of 100 of the larger one's shingles, so so many can't all miss
        assert n - size < -(-80 * n // 100) <= n - size + 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (30, 30)] + [(i, i + 1) for i in range(100, 160)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[i] for i in (1, 2, 3, 7, 8, 9)} == {1} and got[21] == 20 and got[160] == 100 and 30 not in got
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(odd, clashing, empty):
    rows = found(jaccard.near_duplicates(odd))
    assert len(rows) == 13
    by = {r[0]: r for r in rows if r[0] is not None}
    assert by[4][2] == by[5][2] == 4 and by[6][2] == 4 and by[1] == (1, 0, 1) and by[3] == (3, 0, 3) and by[8][1] == 1
    assert [r[2] for r in rows if r[0] is None] == [None, None]
    assert found(jaccard.near_duplicates(clashing)) == rows
    assert jaccard.near_duplicates(empty).collect() == []


def test_parts_of_a_batch_dont_matter(monkeypatch):
    import pyarrow as pa

    from goldrec.llm import shingles

    texts = pa.array(["a b c d e f g", None, "", "  x  y", "AbC " * 50, "q" * 300, "é ü\tö\nä w " * 20] * 3)
    whole = [s.tolist() for s in shingles.shingle_sets(texts)]
    for step in (1, 7, 50):
        monkeypatch.setattr(shingles, "STEP", step)
        assert [s.tolist() for s in shingles.shingle_sets(texts)] == whole


def test_long_words_that_differ_differ(spark):
    """A word of two letters in the order of its digit sums and its complement: equal under powers of any odd number."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(4_096))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(i, w + " " + tail) for i, (w, tail) in enumerate((w, t) for t in ("", "x y", "a b c d e f") for w in (word, other))], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect())) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])

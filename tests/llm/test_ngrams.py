import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldrec.llm import ngrams, quality, queries
from llm.conftest import found

LABELS = "doc_id long, quality int, toxic int"


def grams(text):
    s = [ngrams.BEGIN] * (ngrams.ORDER - 1) + list(text.encode())
    return list(zip(*[s[i:] for i in range(ngrams.ORDER)]))


def brute_model(texts):
    """Interpolated modified Kneser-Ney of five symbols, written out with dictionaries."""
    counts = [Counter(g for t in texts for g in grams(t))]
    for _ in range(ngrams.ORDER - 1):
        counts.append(Counter(g[1:] for g in counts[-1]))
    levels = []
    for table in reversed(counts):
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2])
        d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 for k in (1, 2, 3)]
        d = [max(0.05, min(x, k - 0.05)) for k, x in zip((1, 2, 3), d)]
        total, left = Counter(), Counter()
        for g, c in table.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3) - 1]
        levels.append((table, d, total, left))

    def p(g):
        at = 1 / (ngrams.BEGIN + 1)
        for k, (table, d, total, left) in enumerate(levels, 1):
            h = g[-k:]
            if total[h[:-1]]:
                c = table[h]
                at = ((c - d[min(c, 3) - 1] if c else 0) + left[h[:-1]] * at) / total[h[:-1]]
        return at
    return lambda text: sum(-math.log(p(g)) for g in grams(text))


def test_grams_of_a_batch_dont_touch_and_long_texts_go_on(monkeypatch):
    monkeypatch.setattr(ngrams, "STEP", 7)
    texts = [b"abc", b"", b"d", b"the quick brown fox jumps over", b"xyzxyz"]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    parts = list(ngrams.pieces(np.frombuffer(b"".join(texts), np.uint8), offsets))
    wanted = [sum(x << ngrams.BITS * (ngrams.ORDER - 1 - i) for i, x in enumerate(g)) for t in texts for g in grams(t.decode())]
    assert np.concatenate([g for g, _ in parts]).tolist() == wanted
    assert sum(np.diff(edges) for _, edges in parts).tolist() == [len(t) for t in texts]


def test_perplexity_equals_brute_force_over_several_blocks(spark, monkeypatch):
    """Languages with a model of their own, one with few documents, null, and documents without labels."""
    monkeypatch.setattr(ngrams, "BLOCK", 400)
    monkeypatch.setattr(ngrams, "PENDING", 50)
    rng = np.random.default_rng(1)
    langs = ["aa"] * 30 + ["bb"] * 30 + ["few"] * 4 + [None] * 3
    words = {lang: ["".join(rng.choice(list("abcdé XYZ,"), 4)) for _ in range(9)] for lang in set(langs)}
    docs = [(i, " ".join(rng.choice(words[lang], 8 + i % 5)), lang) for i, lang in enumerate(langs)]
    labels = [(i, 1, 0) for i in range(len(docs)) if i % 10 != 9]
    rows = {r["doc_id"]: r for r in ngrams.quality_report(spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, LABELS)).collect()}
    assert len(rows) == len(docs)
    good = {i for i, _, _ in labels}
    own = [lang if lang in ("aa", "bb") else quality.ALL for lang in langs]
    for model in ("aa", "bb", quality.ALL):
        members = [i for i in good if own[i] == model or model == quality.ALL]
        cost = brute_model([docs[i][1] for i in members if i in good])
        size = lambda i: len(docs[i][1].encode())
        mean = sum(cost(docs[i][1]) for i in members) / sum(map(size, members))
        ppl = lambda i: math.exp((cost(docs[i][1]) + quality.PRIOR * mean) / (size(i) + quality.PRIOR))
        limit = sorted(map(ppl, members))[math.ceil(quality.QUANTILE * len(members)) - 1]
        for i in (i for i in range(len(docs)) if own[i] == model):
            assert rows[i]["perplexity"] == pytest.approx(ppl(i), rel=1e-5) and rows[i]["threshold"] == pytest.approx(limit, rel=1e-5)
            assert rows[i]["kept"] == (ppl(i) <= limit * (1 + 1e-9))


def test_a_fifth_of_the_trusted_documents_is_measured_and_not_learned(spark):
    rng = np.random.default_rng(2)
    docs = [(i, "".join(rng.choice(list("abcdef "), 60)), "aa") for i in range(300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = {r["doc_id"]: r for r in ngrams.quality_report(frame, spark.createDataFrame([(i, 1, 0) for i in range(300)], LABELS)).collect()}
    held = {r[0] for r in frame.where(F.pmod(F.xxhash64("doc_id"), F.lit(ngrams.HELD_OUT)) == 0).select("doc_id").collect()}
    assert quality.LEAST <= len(held) < 100
    assert min(rows[i]["perplexity"] for i in held) > np.median([r["perplexity"] for i, r in rows.items() if i not in held])
    assert rows[0]["threshold"] == pytest.approx(max(rows[i]["perplexity"] for i in held), rel=1e-9)


def test_query_tells_bytes_apart_that_classes_fold(spark, tmp_path):
    """The model's size follows the text: capitals and digits are not one class each, and contexts are longer than two bytes."""
    docs = [(i, "ABBA 1221 ABBA 1221", "en", "a", 19) for i in range(30)] + [(30, "QXZQ 7987 QXZQ 7987", "en", "a", 19), (31, "BAAB 2112 BAAB 2112", "en", "a", 19)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(30)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    kept = {r["doc_id"]: r["kept"] for r in queries.op3_quality(spark, str(tmp_path)).collect()}
    assert sorted(i for i, k in kept.items() if not k) == [30, 31]


def test_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 1, 0), (8, 1, None), (9, 0, 0), (None, 1, 0)], LABELS)
    rows = found(ngrams.quality_report(odd, labels))
    assert len(rows) == 13
    assert all(not r[4] and r[2] is None for r in rows if r[0] in (1, 2))
    assert found(ngrams.quality_report(clashing, labels)) == rows
    kept = ngrams.judge(clashing, labels).where("kept").select("row.*")
    assert kept.columns == clashing.columns
    every = ngrams.judge(clashing, labels).select("row.*")
    assert found(every) == found(clashing)
    assert {r["kept"] for r in ngrams.quality_report(odd.where("doc_id > 2"), labels.limit(0)).collect()} == {True}
    assert ngrams.quality_report(empty, labels).collect() == []


def test_keeps_clean_and_rejects_junk(spark, sf):
    big = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = ngrams.quality_report(docs, labels).join(labels, "doc_id").collect()
    share = lambda q, t: np.mean([r["kept"] for r in rows if r["quality"] == q and r["toxic"] == t])
    assert share(1, 0) > 0.99 and share(0, 0) < 0.2

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from goldrec.llm import quality
from goldrec.llm.shingles import buffers
from llm.conftest import found


def brute_model(texts):
    """Interpolated modified Kneser-Ney of three symbols, written out with dictionaries."""
    begin = quality.BEGIN
    three = Counter()
    for t in texts:
        s = [begin, begin, *quality.CLASSES[np.frombuffer(t.encode(), np.uint8)].tolist()]
        three.update(zip(s, s[1:], s[2:]))
    two = Counter((b, c) for a, b, c in three)
    one = Counter((c,) for b, c in two)

    def discounts(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2])
        d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.5 for k in (1, 2, 3)]
        return [max(0.05, min(x, k - 0.05)) for k, x in zip((1, 2, 3), d)]

    def level(counts, lower):
        d, total, left = discounts(counts), Counter(), Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            left[gram[:-1]] += d[min(n, 3) - 1]

        def p(gram):
            context = gram[:-1]
            if not total[context]:
                return lower(gram[1:])
            n = counts[gram]
            return ((n - d[min(n, 3) - 1] if n else 0) + left[context] * lower(gram[1:])) / total[context]
        return p

    p1 = level(one, lambda _: 1 / quality.SYMBOLS)
    return level(three, level(two, lambda g: p1(g)))


def test_model_equals_brute_force(spark):
    texts = ["the cat sat on the mat", "a cat is a cat, a mat is a mat", "The 3 dogs!", "été"]
    model = quality.fit(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"))
    assert model.langs == ["", "en"]
    p = brute_model(texts)
    for text in ["the mat", "zzz", "A cat? *** été"]:
        gram = quality.trigrams(*buffers(pa.array([text])))
        s = [quality.BEGIN, quality.BEGIN, *quality.CLASSES[np.frombuffer(text.encode(), np.uint8)].tolist()]
        wanted = [-math.log(p(g)) for g in zip(s, s[1:], s[2:])]
        for lang in range(2):
            assert model.cost[lang][gram].tolist() == pytest.approx(wanted, rel=1e-4)
    assert np.exp(-model.cost.reshape(2, 64, 64, 64).astype(float)).sum(axis=3) == pytest.approx(1, rel=1e-3)


def test_texts_of_a_batch_dont_touch():
    both = quality.trigrams(*buffers(pa.array(["abc", None, "", "d", "ef"])))
    alone = np.concatenate([quality.trigrams(*buffers(pa.array([t]))) for t in ("abc", "d", "ef")])
    assert both.tolist() == alone.tolist()


def test_keeps_clean_and_rejects_junk(spark, sf):
    big = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_report(docs, labels).join(labels, "doc_id").collect()
    share = lambda q, t: np.mean([r["kept"] for r in rows if r["quality"] == q and r["toxic"] == t])
    assert share(1, 0) > 0.99 and share(0, 0) < 0.2


def test_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 1, 0), (8, 1, None), (9, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = found(quality.quality_report(odd, labels))
    assert len(rows) == 13
    assert all(not r[4] and r[2] is None for r in rows if r[0] in (1, 2))
    assert found(quality.quality_report(clashing, labels)) == rows
    kept = quality.judge(clashing, labels).where("kept").select("row.*")
    assert kept.columns == clashing.columns
    assert {r["kept"] for r in quality.quality_report(odd.where("doc_id > 2"), labels.limit(0)).collect()} == {True}
    assert quality.quality_report(empty, labels).collect() == []


def test_rows_without_a_model_of_their_own_are_judged_by_that_of_all(spark):
    """The 33rd and later languages have a model; a null language and one of 5 documents take mean, cost and threshold of all."""
    rng = np.random.default_rng(0)
    langs = [f"l{i:02}" for i in range(36) for _ in range(22)] + ["few"] * 5 + [None] * 5
    letters = {lang: rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 5) for lang in set(langs) - {None}} | {None: list("aeiou qxz,")}
    docs = [(i, "".join(rng.choice(letters[lang], 60 + i % 50)), lang) for i, lang in enumerate(langs)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(len(docs))], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality.quality_report(frame, labels).collect()}

    own = [lang if lang not in ("few", None) else quality.ALL for lang in langs]
    model = quality.fit(spark.createDataFrame([(o, t) for o, (_, t, _) in zip(own, docs)], "lang string, text string"))
    assert len(model.langs) == 37
    gram = [quality.trigrams(*buffers(pa.array([t]))) for _, t, _ in docs]
    cost = lambda lang, i: float(model.cost[model.langs.index(lang)][gram[i]].sum(dtype=float))
    for lang in ("l00", "l35", quality.ALL):
        members = [i for i in range(len(docs)) if lang in (own[i], quality.ALL)]
        mean = sum(cost(lang, i) for i in members) / sum(len(gram[i]) for i in members)
        ppl = {i: math.exp((cost(lang, i) + quality.PRIOR * mean) / (len(gram[i]) + quality.PRIOR)) for i in members}
        limit = sorted(ppl.values())[math.ceil(quality.QUANTILE * len(ppl)) - 1]
        for i in (i for i in members if own[i] == lang):
            assert rows[i]["perplexity"] == pytest.approx(ppl[i], rel=1e-5) and rows[i]["threshold"] == pytest.approx(limit, rel=1e-5)
            assert rows[i]["kept"] == (ppl[i] <= limit * (1 + 1e-9))

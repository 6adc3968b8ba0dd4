import math
import re
from collections import Counter

import pytest

from goldrec.llm import language
from llm.conftest import found


@pytest.fixture(scope="module")
def sixty(spark, sf):
    return spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")


def test_held_out_accuracy(sixty):
    rows = language.identify(sixty).join(sixty.select("doc_id", "lang", "n_chars"), "doc_id").where("held_out and n_chars > 40").collect()
    assert len(rows) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_backs_off_from_words_to_shorter_grams():
    rows = [("a", 0, "known", 5), ("b", 0, "known", 1), ("a", 0, "other", 1), ("b", 0, "other", 5), ("a", 3, " kn", 4), ("b", 2, "zz", 9), ("a", 2, "qq", 9), ("a", 1, "y", 1), ("b", 1, "y", 3), ("a", 1, "e", 3), ("b", 1, "e", 1)]
    model = language.Model(rows)
    assert model.word("known")[0] > model.word("known")[1]  # as a word
    assert model.word("zzz")[1] > model.word("zzz")[0]  # two of its bigrams
    assert model.word("y")[1] > model.word("y")[0]  # one letter
    assert not model.word("öö").any()


def test_word_scores_equal_brute_force():
    rows = [("a", 0, "x", 3), ("b", 0, "x", 1), ("b", 0, "yy", 2)]
    model = language.Model(rows)
    smoothed = {"a": {"x": 3.5, "yy": 0.5}, "b": {"x": 1.5, "yy": 2.5}}
    scorer = language.Scorer(model)
    total = {lang: sum(n * math.log(w[k] / sum(w.values())) for k, n in Counter(re.findall(r"\w+", "x yy X")).items() for k in [k.lower()])
             for lang, w in smoothed.items()}
    lang, score = scorer.predict("x yy X")
    assert lang == max(total, key=total.get)
    assert score == pytest.approx(1 / (1 + math.exp(min(total.values()) - max(total.values()))), rel=1e-4)


def test_small_memory_gives_the_same(sixty):
    model = language.fit(sixty.limit(200))
    texts = [r["text"] for r in sixty.select("text").limit(30).collect()]
    small, large = language.Scorer(model, keep=40), language.Scorer(model)
    assert [small.predict(t)[0] for t in texts] == [large.predict(t)[0] for t in texts]


def test_odd_rows(odd, clashing, empty):
    rows = found(language.identify(odd))
    assert len(rows) == 13
    assert all(r[2] == "und" and r[3] == 0 for r in rows if r[0] in (1, 2, 3, 9))
    assert found(language.identify(clashing)) == rows
    assert language.identify(empty).collect() == []
    assert {r["lang_pred"] for r in language.predict(odd, language.fit(empty), ["doc_id"]).collect()} == {"und"}


def test_letters_and_marks(sixty):
    """Raised digits and fractions are no letters; marks belong to the letter before."""
    model = language.fit(sixty.limit(100))
    scorer = language.Scorer(model)
    for text in ("²³", "½ ² 12", "_ 7", "  "):
        assert scorer.predict(text) == ("und", 0.0)
    assert scorer.predict("x²")[0] != "und"
    assert set(language.words_of("नमस्ते दुनिया e\u0301t")) == {"नमस्ते", "दुनिया", "e\u0301t"}


def test_a_small_language_keeps_its_words(spark):
    rows = [("big", " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3_000)))] * 5 + [("small", "kvik kvik blom blom")]
    df = spark.createDataFrame(rows, "lang string, text string")
    model = language.fit(df, max_words=50, max_grams=50)
    assert {"kvik", "blom"} <= set(model.units[0])
    assert language.Scorer(model).predict("blom kvik")[0] == "small"


def test_whole_texts_equal_brute_force(sixty):
    """Prediction and score of whole texts from the model's word scores, one word at a time."""
    model = language.fit(sixty.limit(300))
    scorer = language.Scorer(model)
    for r in sixty.select("text").limit(40).collect():
        total = sum((model.word(w).astype(float) for w in re.findall(r"[^\W\d_]+", r["text"].lower())), 0.0)
        lang, score = scorer.predict(r["text"])
        best = max(range(len(model.langs)), key=lambda i: total[i])
        assert lang == model.langs[best]
        assert score == pytest.approx(1 / sum(math.exp(t - total[best]) for t in total), rel=1e-3)

import random
import time
import zlib

import pytest
from pyspark.sql import functions as F

from goldrec.llm import toxicity
from goldrec.llm.common import table
from llm.conftest import found


def test_held_out_rows_are_told_apart(spark):
    """Labels of rows that may not be learned from are the test: ranking and verdicts over sf0.01."""
    sf = "/root/testdata/sf0.01"
    rows = toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    rows = rows.join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    bad, good = ([r["score"] for r in rows if r["toxic"] == t] for t in (1, 0))
    better = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert better > 0.8 and sum(g >= 0.5 for g in good) <= 0.02 * len(good)


@pytest.fixture(scope="module")
def made(spark):
    """Toxic texts hold a word of a made-up stem in one language, a disguised insult in another."""
    rng = random.Random(5)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(1_500):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 6 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["zwork" + rng.choice(words), "1d10t", "m.o.r.o.n", "IDIOOOOT"]))
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_stems_and_disguises_are_learned(made):
    documents, labels = made
    rows = toxicity.toxicity(documents, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.97 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_only_allowed_labels_teach(made):
    """Wrong labels on held-out rows change nothing, nor do the order of rows and other columns."""
    documents, labels = made
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    few = documents.where("doc_id < 400")
    other = few.select("*", F.lit("xx").alias("lang"), F.lit("s").alias("source"), F.lit(9).alias("score"), F.lit(9).alias("features"), F.lit(9).alias("toxic"))
    want = [(r[0], r[1], round(r[2], 9), r[3]) for r in found(toxicity.toxicity(few, labels))]
    assert [(r[0], r[1], round(r[2], 9), r[3]) for r in found(toxicity.toxicity(other, flipped))] == want


def test_odd_rows(spark, odd, clashing, empty, made):
    labels = spark.createDataFrame([(4, 1), (4, None), (5, 0), (6, 1), (7, 0), (9, 0), (10, 1), (None, 1)], "doc_id long, toxic int")
    rows = found(toxicity.toxicity(odd, labels))
    assert len(rows) == 13 and all(0 <= r[2] <= 1 for r in rows)
    assert len({r[2] for r in rows if r[0] in (1, 2, 3)}) == 1
    assert found(toxicity.toxicity(clashing, labels)) == rows
    assert toxicity.toxicity(empty, labels).collect() == []
    assert {r[2] for r in found(toxicity.toxicity(odd, labels.where("false")))} == {0.0}
    assert {r[2] for r in found(toxicity.toxicity(odd, labels.where("toxic = 1")))} == {1.0}


def test_the_sample_is_bounded(made):
    documents, labels = made
    copies = documents.unionByName(documents).unionByName(documents.withColumn("doc_id", F.lit(7).cast("long")))
    known = toxicity.fitting_rows(copies, labels, 300)
    assert 200 < known.count() < 400
    assert known.select("text").distinct().count() == known.count()


def test_features_are_linear_in_the_text():
    lexicon = toxicity.Lexicon({"vile": 3.0, "^zwor": 4.0})
    plain = toxicity.features("you are a vile zworkish m0r0n, YOU STUPID one!!", lexicon)
    named = dict(zip(toxicity.FEATURES, plain))
    assert named["highest"] == 4.0 and named["near_you"] > 0 and named["uncovered"] > 0 and named["shouted"] > 0 and named["calls"] > 0
    for hard in ("a" * 200_000, "a.b" * 100_000, "a1" * 100_000, "!" * 200_000, "aaab" * 50_000, "İ" * 50_000):
        begun = time.perf_counter()
        toxicity.features(hard, lexicon)
        assert time.perf_counter() - begun < 3

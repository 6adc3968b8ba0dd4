import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from goldrec.llm import mixing
from llm.conftest import found


def brute_targets(sizes):
    """Share by weight, stop at the cap, share the excess anew, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(full.values())
        goal = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        above = [s for s in rest if goal[s] > 2 * sizes[s]]
        if not above:
            return {**full, **goal}
        full |= {s: 2.0 * sizes[s] for s in above}


@pytest.mark.parametrize("block", [mixing.BLOCK, 7])
def test_targets_and_what_is_taken(documents, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    monkeypatch.setattr(mixing, "RUN", 100)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 9)
    rows = mixing.mix_report(documents).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(source)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", text[r["doc_id"]]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[source[r["doc_id"]]] += r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    goals = brute_targets(sizes)
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goals[s])
    for s in sizes:
        assert abs(taken[s] - goals[s]) <= max(8, 0.02 * goals[s])
    assert found(mixing.mix_report(documents.repartition(5))) == sorted(map(tuple, rows), key=lambda r: [(x is None, str(x)) for x in r])


def test_any_stretch_has_the_wanted_shares(spark):
    goals = spark.createDataFrame([("a", 10, 6_000.0), ("b", 10, 3_000.0), (None, 10, 1_000.0)], "source string, source_size long, target double")
    order = [r["source"] for r in mixing.schedule(goals, 4_000).orderBy("slot").collect()]
    assert len(order) == 4_000
    for at in range(0, 3_900, 130):
        part = order[at:at + 100]
        assert abs(part.count("a") - 60) <= 3 and abs(part.count("b") - 30) <= 3


def test_words_are_taken_once_per_pass(documents):
    """The slots of a pass that meet a document take its words one behind another, none twice."""
    rows = mixing.prepared(documents)
    parts = mixing.mixture(rows, slots=300).groupBy("doc_id", "size", "pass").agg(F.sum("taken").alias("taken"), F.count("slot").alias("n"), F.countDistinct("slot").alias("m"))
    assert all(r["taken"] <= r["size"] and r["n"] == r["m"] for r in parts.collect())


def test_documents_of_the_mix(documents):
    report = {r["doc_id"]: r for r in mixing.mix_report(documents).collect()}
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert taken == {i: r["taken"] for i, r in report.items() if r["taken"]}


def test_odd_rows(odd, clashing, empty):
    rows = found(mixing.mix_report(odd))
    assert len(rows) == 13 and all(r[4] <= 2 * r[1] for r in rows)
    assert found(mixing.mix_report(clashing)) == rows
    assert mixing.mixed_documents(clashing).columns == clashing.columns
    assert mixing.mix_report(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


@pytest.mark.parametrize("slots", [None, 64])
def test_each_of_many_tiny_sources_takes_its_target(spark, slots):
    """One huge source and 60 of less than a block; and a null one."""
    words = [("huge", i, 2_000) for i in range(50)] + [(f"s{i:02}", 100 + i, 3 + i) for i in range(60)] + [(None, 200, 7)]
    docs = spark.createDataFrame([(i, "w " * n, s) for s, i, n in words], "doc_id long, text string, source string")
    rows = mixing.mixture(mixing.prepared(docs), slots=slots)
    got = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.countDistinct("doc_id").alias("docs")).collect()
    assert len(got) == 62 and sum(r["docs"] for r in got) == len(words)
    for r in got:
        assert r["target"] > 0 and r["taken"] > 0 and abs(r["taken"] - r["target"]) <= 1
    per = rows.groupBy("doc_id", "pass").agg(F.sum("taken").alias("taken"), F.first("size").alias("size")).collect()
    assert all(0 <= r["taken"] <= r["size"] for r in per)


def test_blocks_stay_and_slots_grow(spark, monkeypatch):
    goals = spark.createDataFrame([("a", 9_000, 90_000.0), ("b", 1_000, 10_000.0)], "source string, source_size long, target double")
    assert mixing.blocks(goals) == (98, 1_024.0) and mixing.blocks(goals, 500) == (500, 200.0)
    want = {tuple(r) for r in mixing.schedule(goals, 500).collect()}
    assert len(want) == 500
    monkeypatch.setattr(mixing, "RUN", 7)  # ranks are counted in runs
    assert {tuple(r) for r in mixing.schedule(goals, 500).collect()} == want
    ranks = sorted((r[1], r[0], r[2]) for r in want)
    assert all(x[2] + 1 == y[2] for x, y in zip(ranks, ranks[1:]) if x[0] == y[0])


def test_the_points_decide_the_order(documents, monkeypatch):
    """With the points in plain order the mix is another one; with its own, any stretch of it has the wanted shares."""
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rows = mixing.mix_report(documents).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    slots = mixing.schedule(mixing.targets(mixing.prepared(documents).groupBy("source").agg(F.sum("size").alias("source_size")))).orderBy("slot").collect()
    goal = {source[r["doc_id"]]: r["target"] for r in rows}
    whole = sum(goal.values())
    for at in range(0, len(slots) - 400, 211):
        part = [r["source"] for r in slots[at:at + 400]]
        for s, t in goal.items():
            assert abs(part.count(s) / 400 - t / whole) < 0.02
    mixed = [r["doc_id"] for r in mixing.mixed_documents(documents).collect()]
    monkeypatch.setattr(mixing, "GOLDEN", 1)
    assert {(r["doc_id"], r["slot"]) for r in mixing.mix_report(documents).collect()} != {(r["doc_id"], r["slot"]) for r in rows}
    assert [r["doc_id"] for r in mixing.mixed_documents(documents).collect()] != mixed

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from goldrec.llm import trie
from goldrec.llm.common import table
from llm.conftest import found

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    """Every node from every prefix, with the contract's columns."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    children, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, members in nodes.items():
        size = (len(members) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += size
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if built[c] == p)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


def nodes_of(df):
    return found(trie.prefix_nodes(df))


@pytest.mark.parametrize("fewest", [2, 7, trie.FEWEST])
def test_equals_brute_force(spark, sf, monkeypatch, fewest):
    """Also with two paths a task, where most nodes survive several rounds."""
    monkeypatch.setattr(trie.trie, "__defaults__", (fewest,))
    conversations = table(spark, sf, "conversations")
    assert nodes_of(conversations) == brute_trie(conversations.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_beginnings(spark, monkeypatch, seed):
    """Few different turns, so that conversations share long beginnings, repeat, and end inside others; one first turn is everybody's."""
    rng = random.Random(seed)
    rows = [(c, t, "u", rng.choice(["a", "bé"]) if t > 1 else "hello") for c in range(0, 400, 5) for t in range(rng.randint(1, 12))]
    rows += [(c, t, "u", rng.choice(["a", "bé"])) for c in range(3, 300, 7) for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(trie.trie, "__defaults__", (5,))
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert nodes_of(df) == brute_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_depth_costs_no_rounds(spark, monkeypatch):
    """Conversations of 300 turns that part at the end: a few jobs, however deep."""
    rows = [(c, t, "u", f"t{t}" if t < 299 else f"end {c}") for c in range(0, 60, 5) for t in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    calls = []
    real = trie.peel
    monkeypatch.setattr(trie, "peel", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(trie.trie, "__defaults__", (3,))
    assert nodes_of(df) == brute_trie(rows)
    assert len(calls) <= 4


def test_odd_rows(spark):
    rows = [(0, None, None, None), (0, 1, "u", ""), (0, 1, "u", ""), (5, None, "", ""), (5, 1, "u", ""), (5, 1, "u", ""), (None, 1, "u", "lost"),
            (1, 3, "u", "x" * 100_000), (1, 2, None, "é漢🙂"), (-3, 1, "u", "minus"), (2**40, 1, "u", "far"), (7, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute_trie(rows)  # an id below zero is an id like any other
    assert nodes_of(df) == want
    assert nodes_of(df.where("conv_id is null")) == [] == nodes_of(df.where("false"))
    clashing = df.select("*", *[F.lit("other").alias(c) for c in ("path", "node", "parent", "key", "turns", "head", "family", "sizes", "ends", "depth")])
    assert nodes_of(clashing) == want


def test_members_are_hashed_in_order(spark):
    ids = [5 * n for n in range(3_000)] + [10**12, -10]
    df = spark.createDataFrame([(i, "p") for i in ids], "conv_id long, path_id string").repartition(7)
    [row] = trie.member_digests(df).collect()
    assert row["ends"] == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()

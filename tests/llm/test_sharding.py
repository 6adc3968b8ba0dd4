import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from goldrec.llm import sharding
from goldrec.llm.common import first_at_least
from llm.conftest import found


def check(rows, n, shards=40):
    assert len(rows) == n
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_counts_at_most_one_apart(documents):
    rows = sharding.shard_rows(documents).collect()
    check(rows, documents.count())
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    assert found(sharding.shard_rows(documents.repartition(3))) == found(sharding.shard_rows(documents))


def test_equals_a_walk_row_by_row():
    """Rows of each arc in turn, first home and then clockwise, as the walk over counts does it."""
    points = sharding.ring(4, 5)
    owners = [s for _, s in points]
    counts = [(i * 7) % 5 for i in range(len(points))]
    room = sharding.capacities(sum(counts), 4, 0)
    ranges = sharding.walk(owners, counts, room)
    left, homeless, where = list(room), [], {}
    for arc, n in enumerate(counts):
        for k in range(n):
            if left[owners[arc]]:
                left[owners[arc]] -= 1
                where[arc, k] = owners[arc]
            else:
                homeless.append((arc, k))
    for arc, k in homeless:
        step = arc
        while not left[owners[step % len(owners)]]:
            step += 1
        left[owners[step % len(owners)]] -= 1
        where[arc, k] = owners[step % len(owners)]
    assert {(r["arc"], k): r["shard"] for r in ranges for k in range(r["begin"], r["end"])} == where


def test_slack_moves_few_rows_when_a_shard_is_added(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.shard_rows(rows, shards=n, slack=0.25).collect()} for n in (10, 11))
    assert max(Counter(before.values()).values()) <= 20_000 * 1.25 / 10 + 1
    assert sum(before[i] != after[i] for i in before) < 20_000 * 0.25


def test_binary_search(spark):
    points = [-5, 0, 0, 7, 30]
    rows = spark.range(-10, 40).select("id", first_at_least(F.col("id"), points).alias("at")).collect()
    assert all(r["at"] == sum(p < r["id"] for p in points) for r in rows)


def test_one_id_on_a_third_of_all_rows(spark, monkeypatch):
    """Rows without an id, of different and of equal texts: in slices, blocks and every shard."""
    monkeypatch.setattr(sharding, "SLICE_ROWS", 50)
    hot = spark.range(1_000).select(F.lit(None).cast("long").alias("doc_id"), F.when(F.col("id") < 600, F.col("id").cast("string")).otherwise("same").alias("text"))
    rows = spark.range(2_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).unionByName(hot)
    got = sharding.shard_rows(rows).collect()
    check(got, 3_000)
    assert Counter((r["doc_id"], r["text_crc32"]) for r in got) == Counter((r["doc_id"], zlib.crc32(r["text"].encode())) for r in rows.collect())
    assert found(sharding.shard_rows(rows.repartition(7))) == found(sharding.shard_rows(rows))
    plan = sharding.shard_rows(rows)._jdf.queryExecution().toString()
    assert "windowspecdefinition(arc#" in plan and "slice#" in plan


def test_empty_table_with_slack(empty):
    assert sharding.shard_rows(empty, slack=0.3).collect() == []


def test_odd_rows(odd, clashing, empty):
    check(sharding.shard_rows(odd).collect(), 13)
    assert found(sharding.shard_rows(clashing)) == found(sharding.shard_rows(odd))
    assert sharding.shard_rows(empty).collect() == []

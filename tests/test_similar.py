"""Nearly equal values against all pairs, with a block that holds a third of all records."""

import random

import pytest
from pyspark.sql import functions as F

from goldrec.operators import similar
from tests.conftest import rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def all_pairs(values, precision):
    found = set()
    for a in values:
        for b in values:
            if (len(a), a) < (len(b), b) and distance(a, b) <= (100 - precision) * len(b) // 100:
                found.add((a, b))
    return found


def edited(rng, value, edits):
    for _ in range(edits):
        at = rng.randrange(len(value) + 1)
        value = rng.choice([value[:at] + rng.choice("abé") + value[at:], value[:at] + value[at + 1:], value[:at] + "x" + value[at + 1:]]) or "x"
    return value


@pytest.fixture(scope="module")
def records(spark):
    rng, made = random.Random(1), []
    bases = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 45))) for _ in range(25)] + ["", "a", "street " * 5]
    for n in range(1_500):
        block = "hot" if n % 3 == 0 else f"b{n % 7}"
        value = edited(rng, rng.choice(bases), rng.randint(0, 5)) if n % 4 else "the very same street 17"
        made.append((n, None if n % 50 == 0 else block, None if n % 41 == 0 else value))
    return spark.createDataFrame(made, "k int, block string, v string")


@pytest.mark.parametrize("precision", [95, 90, 80, 60])
def test_equals_all_pairs(records, precision):
    want = []
    by_block = {}
    for r in records.collect():
        if r.block and r.v is not None:
            by_block.setdefault(r.block, []).append(r.v)
    for block, values in by_block.items():
        want += [(block, a, b, values.count(a), values.count(b)) for a, b in all_pairs(set(values), precision)]
    found = similar.similar_values(records, "v", precision, ["block"])
    assert rows(found, "block", "VALUE_A", "VALUE_B", "RECORDS_A", "RECORDS_B") == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])
    assert found.filter(F.col("SIMILARITY") < precision).count() == 0


def test_records_know_their_company(records):
    held = [r for r in records.collect()]
    for r in similar.similar_records(records, "k", "v", 80, ["block"]).collect():
        same = [o for o in held if o.block == r.block and o.k != r.k and None not in (o.block, o.v, r.VALUE)]
        near = [o for o in same if o.v != r.VALUE and distance(o.v, r.VALUE) <= 20 * max(len(o.v), len(r.VALUE)) // 100]
        assert (r.EQUAL_RECORDS, r.SIMILAR_RECORDS) == (sum(o.v == r.VALUE for o in same), len(near)), r


def test_a_shared_beginning_brings_nobody_together(spark):
    """20,000 different values that begin alike: what meets stays near the number of values."""
    values = spark.range(20_000).select(F.lit("b").alias("block"), F.concat(F.lit("Customer number "), F.sha2(F.col("id").cast("string"), 256)).alias("v"))
    assert similar.similar_values(values, "v", 97, ["block"]).count() == 0


def test_fields_of_pairs(spark):
    a = ("1", "JOHN A SMITH OF BALTIMORE", "MD", None)
    b = ("1", "JOHN B SMITH OF BALTIMORE", "VA", "x")
    pair = spark.createDataFrame([(a, b)], "a struct<ProviderID:string,FullName:string,State:string,City:string>, b struct<ProviderID:string,FullName:string,State:string,City:string>")
    assert rows(similar.score_pairs(pair), "PASSED", "FAILED", "MISSING") == [(["ProviderID", "FullName"], ["State"], ["City"])]
    with pytest.raises(ValueError):
        similar.score_fields(spark.range(1))

"""Every registered query against its SQL counterpart, order aside."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.oracles import ORACLES
from catalog.queries import QUERIES



@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def canonical(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        return "NULL" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v)

    return [columns[i] for i in order], sorted(tuple(text(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    cursor = duck.execute(ORACLES[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, got) == expected


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_the_catalog():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL counterpart, on the smallest generated tables."""

import os

import duckdb
import pytest

from testdata_queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _comparable(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in data), key=lambda t: [(v is not None, str(v)) for v in t])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = _comparable(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert found
        return
    result = duck.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert found == _comparable(columns, result.fetchall())

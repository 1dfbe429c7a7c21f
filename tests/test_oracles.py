"""Every query against its SQL on the small tables."""

import os

import duckdb
import pytest

from clonespark.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(name, spark, sql):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    result = sql.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    wanted = [tuple(r[names.index(c)] for c in columns) for r in result.fetchall()]
    assert sorted(names) == columns
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key) == sorted(wanted, key=key)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark):
    assert QUERIES[name](spark, DATA).count() > 0

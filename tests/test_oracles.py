"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF

TABLES = ["events", "documents", "embeddings", "lineitem"]


def norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = None if math.isnan(v) else round(v, 6)
            vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


ORACLES = entry.oracle_sql()
QUERIES = entry.QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert norm(got, df.columns) == norm(want, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["pick", "id"]
    assert df.count() == 6


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)

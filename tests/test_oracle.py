"""Every registered query against its DuckDB oracle on the smallest scale."""

import hashlib
import json
import math

import duckdb
import pytest

import __spark_entry__ as E
from tidewater import catalog, oracle

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(oracle.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    want = _rows([d[0] for d in res.description], res.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert len(got) == len(want)
    assert hashlib.sha256("\n".join(got).encode()).digest() == hashlib.sha256("\n".join(want).encode()).digest()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["RRN", "DATAPARTITIONNUM", "DATAPARTITIONNAME"]


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema and a.count() == b.count()

"""Every registered query against its DuckDB oracle (as the driver checks it)."""

import hashlib
import json
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _digest(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        return round(v, 6) if isinstance(v, float) else (None if v is None else str(v))
    lines = sorted(json.dumps([norm(r[i]) for i in order], ensure_ascii=False) for r in rs)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_oracle():
    assert set(E._registry.queries()) == set(E._oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(E._oracle.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _digest(df.columns, s_rows) == _digest(d_cols, d_rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["period", "nbr", "name", "rsi", "rsi_rank", "data_dt"]

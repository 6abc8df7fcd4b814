"""Every registered query against its DuckDB SQL on the smallest data set."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tripstar.plans import oracle, registry
from tripstar.sources.tables import GIVEN_TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in GIVEN_TABLES:
        p = f"{sf_small}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["pickup_weekday", "pickup_hour", "trip_count", "avg_fare"]
    assert df.count() == 168


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_duckdb(spark, sf_small, duck, name):
    df = registry.queries()[name](spark, sf_small)
    res = duck.execute(oracle.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, res.fetchall())

from collections import defaultdict

import duckdb
import pytest

from tests.llm.fixtures import SCHEMA, SF, frame, key_sorted, mixed_rows, needs_data
from tripstar.llm import sharding


def check(rows, out, limit):
    assert key_sorted((r.doc_id, r.n_bytes) for r in out) == key_sorted((i, len((t or "").encode())) for i, t in rows)
    shards = defaultdict(list)
    for r in out:
        shards[(r.depth, r.prefix)].append(r)
    for (depth, prefix), rs in shards.items():
        size = sum(r.n_bytes for r in rs)
        assert {(r.shard_bytes, r.shard_rows, r.over_limit) for r in rs} == {(size, len(rs), size > limit)}
        assert size <= limit or len(rs) == 1  # only a single document may be larger
        # a shard exists because its parent was over the limit
        if depth:
            under = sum(r.n_bytes for r in out if r.depth >= depth and r.prefix >> (r.depth - depth) == prefix ^ 1)
            assert under + size > limit
    return shards


@pytest.mark.parametrize("limit", [100, 1000, 10**6])
def test_shards_fit_and_split_only_when_needed(spark, limit):
    rows = mixed_rows(n=80)
    shards = check(rows, sharding.assign(frame(spark, rows), limit).collect(), limit)
    assert (len(shards) == 1) == (limit == 10**6)


def test_copies_spread(spark):
    rows = [(1, "x" * 100)] * 200 + [(2, "y" * 5000)]
    shards = check(rows, sharding.assign(frame(spark, rows), 1000).collect(), 1000)
    assert len(shards) > 20


def test_empty_table_and_directory(spark):
    assert sharding.assign(spark.createDataFrame([], SCHEMA), 10).count() == 0
    out = sharding.assign(frame(spark, mixed_rows()), 300)
    assert sharding.directory(out).agg({"shard_rows": "sum"}).first()[0] == out.count()


@needs_data
def test_sql_agrees(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql("SELECT doc_id, n_bytes, shard_id, shard_bytes, shard_rows, over_limit FROM (" + sharding.oracle_sql(20_000) + ")").fetchall()
    got = sharding.assign(spark.read.parquet(f"{SF}/documents.parquet"), 20_000).select(
        "doc_id", "n_bytes", "shard_id", "shard_bytes", "shard_rows", "over_limit").collect()
    assert key_sorted(got) == key_sorted(want)
    assert len({r.shard_id for r in got}) > 10


def test_plan_has_no_python(spark):
    plan = sharding.assign(frame(spark, mixed_rows()), 300)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripstar.functions.quantiles import Quantile, exact_quantiles


def _values(spark, groups):
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "g string, v double")


def test_discrete_rank_is_ceil_q_n(spark):
    vals = [float(x) for x in range(1, 101)] + [None, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = exact_quantiles(df, [Quantile("p50", "v", 0.5), Quantile("p99", "v", 0.99),
                               Quantile("p0", "v", 0.0), Quantile("p100", "v", 1.0)]).first()
    assert out["p50"] == 50.0 and out["p99"] == 99.0
    assert out["p0"] == 1.0 and out["p100"] == 100.0


def test_grouped_with_null_group_and_empty_group(spark):
    df = spark.createDataFrame(
        [("a", 3.0), ("a", 1.0), ("a", 2.0), (None, 7.0), (None, 5.0), ("empty", None)],
        "g string, v double")
    out = {r["g"]: r["m"] for r in exact_quantiles(df, [Quantile("m", "v", 0.5)], by=["g"]).collect()}
    assert out["a"] == 2.0
    assert out[None] == 5.0          # NULL keys form their own group
    assert "empty" not in out or out["empty"] is None


def test_duplicates_count_as_separate_ranks(spark):
    df = spark.createDataFrame([(1.0,)] * 7 + [(9.0,)] * 3, "v double")
    out = exact_quantiles(df, [Quantile("p70", "v", 0.7), Quantile("p71", "v", 0.71)]).first()
    assert out["p70"] == 1.0 and out["p71"] == 9.0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-500, max_value=500), min_size=1, max_size=60),
       st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.9, 0.99]))
def test_matches_numpy(spark, ints, q):
    vals = [i / 4 for i in ints]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = exact_quantiles(df, [Quantile("d", "v", q), Quantile("c", "v", q, "cont")]).first()
    assert out["d"] == float(np.quantile(vals, q, method="inverted_cdf"))
    assert math.isclose(out["c"], float(np.quantile(vals, q, method="linear")), rel_tol=1e-9, abs_tol=1e-9)


def test_plan_has_no_python_and_groups_by_value(spark):
    df = spark.range(1000).select((F.col("id") % 17).cast("double").alias("v"), (F.col("id") % 3).alias("g"))
    plan = exact_quantiles(df, [Quantile("m", "v", 0.5)], by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "Window" in plan


def test_hot_group_spread_over_slices(spark):
    # one group holds almost all rows and thousands of distinct values
    rng = np.random.default_rng(3)
    hot = rng.normal(50, 20, 6000).round(3)
    rows = [("hot", float(v)) for v in hot] + [("a", 1.0), ("a", 3.0), ("b", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = {r["g"]: r for r in exact_quantiles(
        df, [Quantile("p50", "v", 0.5), Quantile("p99", "v", 0.99), Quantile("c25", "v", 0.25, "cont")],
        by=["g"], slices=16).collect()}
    assert out["hot"]["p50"] == float(np.quantile(hot, 0.5, method="inverted_cdf"))
    assert out["hot"]["p99"] == float(np.quantile(hot, 0.99, method="inverted_cdf"))
    assert math.isclose(out["hot"]["c25"], float(np.quantile(hot, 0.25)), rel_tol=1e-12)
    assert out["a"]["p50"] == 1.0 and out["b"]["p99"] == 2.0

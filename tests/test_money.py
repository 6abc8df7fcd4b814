import math

import pytest
from pyspark.sql import functions as F

from tripstar.functions.money import exact_mean, exact_mean_key, exact_mean_pct, exact_total

NAN, INF = float("nan"), float("inf")


def agg(spark, values, col):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3).agg(col(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("values", [[.004] * 4 + [.009], [1.0, NAN], [1.0, NAN, 1e21], [1e21, 3e21], [INF, 1.0], [None, 2.0], [],
                                    [None], [-1.005, 2.25, 1e14], [12.299999999999999]])
def test_mean_and_total_equal_the_plain_aggregates(spark, values):
    numbers = [v for v in values if v is not None]
    for col, want in ((lambda x: exact_mean(x, 2), sum(numbers) / len(numbers) if numbers else None),
                      (exact_total, sum(numbers) if numbers else None),
                      (exact_mean_pct, 100 * sum(numbers) / len(numbers) if numbers else None)):
        got = agg(spark, values, col)
        if want is None:
            assert got is None
        elif math.isnan(want):
            assert math.isnan(got)
        else:
            assert got == pytest.approx(want, rel=1e-12, abs=0.0051)


def test_cents_round_half_up(spark):
    assert agg(spark, [.005] * 3, lambda x: exact_mean(x, 2)) == 0.01
    assert agg(spark, [.004] * 4 + [.009], lambda x: exact_mean(x, 2)) == 0.01
    assert agg(spark, [1.0, NAN], exact_mean_key) is None

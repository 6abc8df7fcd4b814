"""Hand-written edge rows for the cleaning order (one case per rule)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import BASE, frame, trip
from tripstar.operators import clean
from tripstar.plans import analytics
from tripstar.operators import star


def _clean(spark, rows):
    return clean.finish(clean.prepare(frame(spark, rows)))


def _by_dropoff(df):
    return {r["tpep_dropoff_datetime"]: r for r in df.collect()}


def _drop(minute, duration=10):
    return BASE + dt.timedelta(minutes=minute + duration)


@pytest.fixture(scope="module")
def cleaned(spark):
    rows = [
        # bin 1.0: fares 10, 12, -5 -> median 10 replaces -5
        trip(minute=1, distance=1.0, fare=10.0, tip=1.0),
        trip(minute=2, distance=1.1, fare=12.0, tip=1.0),
        trip(minute=3, distance=0.9, fare=-5.0, tip=2.0),
        # bin 500: only negative fares -> median stays negative (K2), tip 0 capped below 0
        trip(minute=4, distance=500.0, fare=-20.0, tip=0.0),
        trip(minute=5, distance=500.0, fare=-30.0, tip=0.0),
        # NULL distance + negative fare -> NULL, then the global median fare (K3)
        trip(minute=6, distance=None, fare=-7.0, tip=0.0),
        # NULL fare with a tip: tip left as is, fare imputed later (K4)
        trip(minute=7, distance=3.0, fare=None, tip=50.0),
        # passengers (K5)
        trip(minute=8, passengers=None), trip(minute=9, passengers=0.0), trip(minute=10, passengers=0.4),
        trip(minute=11, passengers=1.5), trip(minute=12, passengers=2.5),
        # NULL pickup (K6) and negative duration (K8)
        trip(minute=13, pickup_null=True), trip(minute=14, duration=-5),
        # tip above fare is capped
        trip(minute=15, fare=8.0, tip=9.0),
        # exact duplicate of the first row
        trip(minute=1, distance=1.0, fare=10.0, tip=1.0),
    ]
    return _by_dropoff(_clean(spark, rows))


def test_duplicates_removed(cleaned):
    assert len(cleaned) == 15


def test_negative_fare_gets_bin_median(cleaned):
    assert cleaned[_drop(3)]["fare_amount_clean"] == 10.0


def test_negative_bin_median_stays_negative(cleaned):
    r4, r5 = cleaned[_drop(4)], cleaned[_drop(5)]
    assert r4["fare_amount_clean"] == -30.0 and r5["fare_amount_clean"] == -30.0
    assert r4["tip_amount_clean"] == -30.0


def test_null_distance_negative_fare_becomes_global_median(cleaned):
    medians = sorted(r["fare_amount_clean"] for r in cleaned.values()
                     if r["tpep_dropoff_datetime"] not in (_drop(6), _drop(7)))
    row = cleaned[_drop(6)]
    assert row["distance_bin"] is None
    # global median of the non-NULL cleaned fares (rank ceil(n/2))
    assert row["fare_amount_clean"] == medians[(len(medians) + 1) // 2 - 1]


def test_null_fare_keeps_tip(cleaned):
    row = cleaned[_drop(7)]
    assert row["tip_amount_clean"] == 50.0
    assert row["fare_amount_clean"] is not None


def test_passengers(cleaned):
    got = [cleaned[_drop(m)]["passenger_count_clean"] for m in (8, 9, 10, 11, 12)]
    assert got == [1, 1, 1, 2, 3]


def test_null_pickup_and_negative_duration(cleaned):
    row = cleaned[_drop(13)]
    assert row["pickup_hour"] is None and row["time_of_day"] == "night"
    assert row["trip_duration_minutes"] is not None  # imputed with the median
    assert cleaned[_drop(14, -5)]["trip_duration_minutes"] == -5.0


def test_tip_capped(cleaned):
    assert cleaned[_drop(15)]["tip_amount_clean"] == 8.0


def test_time_of_day_and_buckets(spark):
    hours = [4, 5, 11, 12, 16, 17, 21, 22]
    rows = [trip(minute=h * 60 + 1, distance=d) for h, d in zip(hours, [-1.0, 1.99, 2.0, 6.99, 7.0, 1.0, 1.0, 1.0])]
    got = {r["pickup_hour"]: (r["time_of_day"], r["distance_bucket"]) for r in _clean(spark, rows).collect()}
    assert [got[h][0] for h in hours] == ["night", "morning", "morning", "afternoon", "afternoon",
                                          "evening", "evening", "night"]
    assert [got[h][1] for h in hours[:5]] == ["short", "short", "medium", "medium", "long"]


def test_p99_cap(spark):
    rows = [trip(minute=i, distance=float(i)) for i in range(1, 201)]
    df = _clean(spark, rows)
    mx = df.agg(F.max("trip_distance_clean")).first()[0]
    assert mx == 198.0  # rank ceil(0.99 * 200) = 198


def test_zero_variance_correlation_is_null(spark):
    rows = [trip(minute=i, distance=1.0, fare=10.0) for i in range(60)]
    c = _clean(spark, rows)
    s = star.build_star(c)
    out = analytics.q2_distance_fare_correlation(s.fact_trips).collect()
    assert len(out) == 1 and out[0]["distance_fare_corr"] is None and out[0]["trip_count"] == 60


def test_having_filters_before_share_window(spark):
    # location 1, hour 0: 120 card trips and 30 cash trips; cash group is below
    # the threshold, so the surviving card group holds 100 % of the share.
    rows = [trip(minute=i % 50, payment=1, fare=10.0 + i / 100) for i in range(120)]
    rows += [trip(minute=i % 50, payment=2, fare=20.0 + i / 100) for i in range(30)]
    s = star.build_star(_clean(spark, rows))
    out = analytics.q3_payment_preference_time_location(s.fact_trips, s.dim_datetime, s.dim_payment).collect()
    assert [(r["payment_desc"], r["trip_count"], r["payment_share_pct"]) for r in out] == [("Credit card", 120, 100.0)]


def test_approximate_mode_runs_and_is_close(spark, sf_small):
    from tripstar.sources.tables import raw_trips
    prepared = clean.prepare(raw_trips(spark, sf_small))
    df = clean.clean_tip(clean.clean_passengers(clean.clean_fare(prepared, clean.fare_bin_medians(prepared))))
    exact = clean.global_stats(df).first()
    approx = clean.global_stats(df, accuracy=10000).first()
    for k in clean.STAT_COLUMNS:
        assert abs(exact[k] - approx[k]) <= 0.05 * max(1.0, abs(exact[k])), k


def test_dedupe_aggregates_rows_only_where_they_meet(spark):
    """No aggregate before the exchange: it would hold nearly every row of a task."""
    rows = [trip(fare=f, tip=t) for f, t in ((0.0, 1.0), (-0.0, 1.0), (float("nan"), None), (float("nan"), None), (2.0, None))] * 3
    got = clean.drop_exact_duplicates(frame(spark, rows).repartition(4), keep_copies=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and plan.rfind("HashAggregate") < plan.find("Exchange")
    assert sorted(r[clean.COPIES] for r in got.collect()) == [3, 6, 6]
    assert clean.drop_exact_duplicates(frame(spark, rows)).count() == 3

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.helpers import frame, trip
from tripstar.functions.histogram import histogram
from tripstar.operators import profile


def test_histogram_matches_numpy(spark):
    vals = [0.0, 0.1, 0.2, 0.30000000000000004, 0.7, 1.0, 1.0, 2.5, 9.99, 10.0, None]
    df = spark.createDataFrame([(v, 3.0) for v in vals], "a double, c double")
    out = histogram(df, ["a", "c"], bins=50).collect()
    a = sorted((r["bin"], r["count"]) for r in out if r["column_name"] == "a")
    counts, _ = np.histogram([v for v in vals if v is not None], bins=50)
    assert [c for _, c in a] == list(counts)
    c = sorted((r["bin"], r["count"], r["bin_lo"]) for r in out if r["column_name"] == "c")
    counts_c, edges_c = np.histogram([3.0] * len(vals), bins=50)   # constant: widened by 0.5
    assert [x[1] for x in c] == list(counts_c)
    assert [x[2] for x in c] == list(edges_c[:-1])


def test_issue_counts_match_pandas(spark):
    rows = [trip(minute=1, fare=-1.0, tip=0.0), trip(minute=2, passengers=0.0),
            trip(minute=3, passengers=1.5), trip(minute=4, passengers=None),
            trip(minute=5, fare=5.0, tip=6.0), trip(minute=6, distance=100.0),
            trip(minute=1, fare=-1.0, tip=0.0)]
    df = frame(spark, rows)
    pdf = df.toPandas()
    rep = {r["issue"]: r for r in profile.issue_report(df, "2024-01-01 00:03:30").collect()}
    assert rep["Duplicate rows"]["n"] == pdf.duplicated().sum() == 1
    assert rep["Negative fare amount"]["n"] == (pdf.fare_amount < 0).sum()
    assert rep["Zero passenger count"]["n"] == (pdf.passenger_count == 0).sum()
    non_int = (~pdf.passenger_count.apply(lambda x: float(x).is_integer())).sum()
    assert rep["Passenger count non-integer"]["n"] == non_int == 2
    assert rep["Tip greater than fare"]["n"] == (pdf.tip_amount > pdf.fare_amount).sum()
    q1, q3 = pdf.trip_distance.quantile(0.25), pdf.trip_distance.quantile(0.75)
    iqr = q3 - q1
    out = ((pdf.trip_distance < q1 - 1.5 * iqr) | (pdf.trip_distance > q3 + 1.5 * iqr)).sum()
    assert rep["Trip distance outliers (IQR)"]["n"] == out
    assert rep["Future pickup timestamps"]["n"] == (pdf.tpep_pickup_datetime > pd.Timestamp("2024-01-01 00:03:30")).sum()
    assert rep["Duplicate rows"]["display"] == "1 (14.29%)"


def test_stats_and_missing(spark):
    rows = [trip(minute=i, distance=float(i), fare=None if i == 3 else 10.0 * i) for i in range(1, 6)]
    df = profile.profile_frame(frame(spark, rows))
    stats = {r["column_name"]: r for r in profile.numeric_stats(df).collect()}
    assert stats["trip_distance"]["median"] == 3.0 and stats["trip_distance"]["std"] == round(np.std([1, 2, 3, 4, 5], ddof=1), 2)
    assert stats["fare_amount"]["median"] == 30.0          # interpolated between 20 and 40
    assert stats["trip_duration_minutes"]["mean"] == 10.0
    miss = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in profile.missing_report(df).collect()}
    assert miss["fare_amount"] == (1, 20.0) and miss["trip_distance"] == (0, 0.0)
    types = {r["column_name"]: r["data_type"] for r in profile.schema_report(df).collect()}
    assert types["tpep_pickup_datetime"] == "timestamp_ntz"


def test_fused_profile_equals_separate_reports(spark, sf_small):
    from tripstar.sources.tables import raw_trips
    df = profile.profile_frame(raw_trips(spark, sf_small))
    fused = profile.profile_reports(df, "2024-01-25 00:00:00")
    separate = {
        "schema": profile.schema_report(df),
        "missing": profile.missing_report(df),
        "statistics": profile.numeric_stats(df),
        "histograms": profile.distribution_report(df),
        "issues": profile.issue_report(df, "2024-01-25 00:00:00"),
    }
    for name, rep in separate.items():
        assert sorted(map(tuple, fused[name].collect())) == sorted(map(tuple, rep.collect())), name


def test_nan_is_missing_in_every_report(spark):
    nan = float("nan")
    rows = [trip(minute=i, distance=float(i), passengers=1.0) for i in range(20)]
    dirty = rows + [trip(minute=30 + i, distance=nan, passengers=nan, fare=nan, tip=nan) for i in range(3)]
    none = rows + [trip(minute=30 + i, distance=None, passengers=None, fare=None, tip=None) for i in range(3)]
    a, b = (profile.profile_frame(frame(spark, r)) for r in (dirty, none))
    for name, report in profile.profile_reports(a, "2024-01-02 00:00:00").items():
        want = profile.profile_reports(b, "2024-01-02 00:00:00")[name]
        assert sorted(map(str, report.collect())) == sorted(map(str, want.collect())), name


def test_issues_of_absent_columns_are_left_out(spark):
    df = frame(spark, [trip(minute=1, fare=-1.0)])
    got = [r["issue"] for r in profile.issue_report(df.drop("tip_amount", "trip_distance")).collect()]
    assert got == ["Duplicate rows", "Negative fare amount", "Zero passenger count", "Passenger count non-integer",
                   "Future pickup timestamps"]
    assert profile.simple_issues(df.select("VendorID")).count() == 0
    assert "issues" in profile.profile_reports(df.select("VendorID", "fare_amount"))


def test_unreadable_timestamps_and_counts(spark):
    from tripstar.operators import clean
    df = frame(spark, [trip(minute=1, passengers=float("nan")), trip(minute=2, passengers=1e12), trip(minute=3, passengers=2.5)])
    df = df.withColumn("tpep_pickup_datetime", F.lit("soon"))
    out = clean.clean_passengers(clean.add_duration(df)).orderBy("tpep_dropoff_datetime").collect()
    assert [r["passenger_count_clean"] for r in out] == [1, 1, 3]
    assert all(r["pickup_ts"] is None and r["trip_duration_minutes"] is None for r in out)


def test_issues_read_the_rows_twice(spark, tmp_path):
    """The quartiles and the duplicate groups: no further scan for the counters."""
    rows = [(None, 2.0, "x"), (1.0, -3.0, "x"), (1.0, -3.0, "x"), (0.0, 900.0, "y"), (2.5, 4.0, None)] * 3
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, "passenger_count double, fare_amount double, note string").selectExpr(
        "*", "fare_amount AS trip_distance", "timestamp '2030-01-01' AS tpep_pickup_datetime").write.parquet(path)
    df = spark.read.parquet(path)
    report = profile.issue_report(df, as_of="2025-01-01")
    got = {r.issue: r.n for r in report.collect()}
    assert got["Duplicate rows"] == 11 and got["Negative fare amount"] == 6 and got["Zero passenger count"] == 3
    assert got["Passenger count non-integer"] == 6 and got["Future pickup timestamps"] == 15
    assert got["Trip distance outliers (IQR)"] == profile.iqr_outliers(df).first().n
    given = spark.createDataFrame([(0.0, 1.0)], "_iq1 double, _iq3 double")
    plan = profile._issues(df, "2025-01-01", given)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1  # with the quartiles given, one scan

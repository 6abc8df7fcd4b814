"""The five business queries (Q1-Q5) over the star schema.

All five have one shape, so they share one helper: group the trips, count them,
add the measures, keep the groups that are large enough
(:func:`group_trips`).  On top of it:

* measures are exact and order-independent (:mod:`tripstar.functions.money`);
* every cut has a total order (group keys break ties), so it is deterministic;
* the Q3 share is taken over the groups that are left, by a window on
  aggregated rows;
* Q5 takes its top rows first and ranks those: a row's dense rank only depends
  on the rows before it, so the ranks are unchanged while the window runs on
  100 rows instead of on every location pair.

Dimensions are small tables read from Parquet; Spark's own size estimate
(autoBroadcastJoinThreshold) broadcasts them, and falls back to a shuffle join
for a large one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions.buckets import weekday_number
from tripstar.functions.money import exact_mean, exact_mean_key, exact_mean_pct, exact_total, pct_of, safe_corr

# Published thresholds (least trips in a group) and limits.
Q2_MIN_TRIPS = 50
Q3_MIN_TRIPS = 100
Q3_LIMIT = 200
Q4_MIN_TRIPS = 100
Q5_MIN_TRIPS = 50
Q5_LIMIT = 100


def group_trips(trips: DataFrame, by: Sequence[str | Column], min_trips: int = 1, **measures: Column) -> DataFrame:
    """One row per group with ``trip_count`` and the measures, without the
    groups of fewer than ``min_trips`` trips."""
    out = trips.groupBy(*by).agg(F.count(F.lit(1)).alias("trip_count"), *[m.alias(name) for name, m in measures.items()])
    return out if min_trips <= 1 else out.where(F.col("trip_count") >= min_trips)


def _at_hour(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    return fact.join(dim_datetime.select("datetime_key", "pickup_weekday", "pickup_hour"), "datetime_key")


def _paid(trips: DataFrame, dim_payment: DataFrame) -> DataFrame:
    return trips.join(dim_payment.select("payment_type", "payment_desc"), "payment_type")


def q1_hour_weekday_volume_fare(fact: DataFrame, dim_datetime: DataFrame) -> DataFrame:
    """Trip volume and mean fare by weekday x hour, in calendar order."""
    grouped = group_trips(_at_hour(fact.select("datetime_key", "fare_amount_clean"), dim_datetime),
                          ["pickup_weekday", "pickup_hour"], avg_fare=exact_mean(F.col("fare_amount_clean"), 2))
    return grouped.orderBy(weekday_number(F.col("pickup_weekday")), "pickup_hour")


def q2_distance_fare_correlation(fact: DataFrame) -> DataFrame:
    """Per 0.1-mile bin: volume, mean fare and within-bin correlation."""
    distance, fare = F.col("trip_distance_clean"), F.col("fare_amount_clean")
    return group_trips(fact, [F.round(distance, 1).alias("distance_bin")], Q2_MIN_TRIPS,
                       avg_fare=exact_mean(fare, 2),
                       distance_fare_corr=F.round(safe_corr(distance, fare), 4)).orderBy("distance_bin")


def q3_payment_preference_time_location(fact: DataFrame, dim_datetime: DataFrame,
                                        dim_payment: DataFrame) -> DataFrame:
    """Payment share within location x hour (groups that are left), top 200."""
    trips = _paid(_at_hour(fact.select("datetime_key", "payment_type", "PULocationID"), dim_datetime), dim_payment)
    place = ["PULocationID", "pickup_hour"]
    grouped = group_trips(trips, [*place, "payment_desc"], Q3_MIN_TRIPS)
    here = F.sum("trip_count").over(Window.partitionBy(*place))
    return (grouped.withColumn("payment_share_pct", pct_of(F.col("trip_count"), here))
                   .orderBy(F.desc("trip_count"), *place, "payment_desc").limit(Q3_LIMIT))


def q4_avg_tip_by_segments(fact: DataFrame, dim_payment: DataFrame) -> DataFrame:
    """Mean tip and mean tip share of fare by payment x distance x vendor."""
    by = ["payment_desc", "distance_bucket", "VendorID"]
    tip, fare = F.col("tip_amount_clean"), F.col("fare_amount_clean")
    grouped = group_trips(_paid(fact, dim_payment), by, Q4_MIN_TRIPS, avg_tip=exact_mean(tip, 2),
                          avg_tip_pct_of_fare=exact_mean_pct(tip / F.nullif(fare, F.lit(0.0))))
    return grouped.orderBy(F.desc("avg_tip"), *by)


def q5_top_location_pairs(fact: DataFrame) -> DataFrame:
    """Location pairs by volume then mean fare, dense-ranked, top 100."""
    pair, fare = ["PULocationID", "DOLocationID"], F.col("fare_amount_clean")
    grouped = group_trips(fact, pair, Q5_MIN_TRIPS, avg_fare=exact_mean(fare, 2),
                          total_revenue=exact_total(F.col("total_revenue")),
                          _mean=exact_mean(fare), _exact=exact_mean_key(fare))
    # the DECIMAL key tells means apart that are one DOUBLE
    order = [F.desc("trip_count"), F.desc("_mean"), F.desc("_exact")]
    top = grouped.orderBy(*order, *pair).limit(Q5_LIMIT)
    return (top.withColumn("pair_rank", F.dense_rank().over(Window.orderBy(*order)))
               .select(*pair, "trip_count", "avg_fare", "total_revenue", "pair_rank").orderBy("pair_rank", *pair))


def run_queries(fact: DataFrame, dim_datetime: DataFrame, dim_payment: DataFrame) -> dict[str, DataFrame]:
    return {
        "q1_hour_weekday_volume_fare": q1_hour_weekday_volume_fare(fact, dim_datetime),
        "q2_distance_fare_correlation": q2_distance_fare_correlation(fact),
        "q3_payment_preference_time_location":
            q3_payment_preference_time_location(fact, dim_datetime, dim_payment),
        "q4_avg_tip_by_segments": q4_avg_tip_by_segments(fact, dim_payment),
        "q5_top_location_pairs": q5_top_location_pairs(fact),
    }

"""Data feeds behind the charts (C1-C5); the drawing itself is not built.

Every feed starts from a bounded query result (at most a few hundred rows),
so the small orderings here never touch trip-level data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINE_TOP_WEEKDAYS = 4
BAR_TOP_PAIRS = 10
PAYMENT_TOP_SLOTS = 12
TIP_TOP_SEGMENTS = 12


def feed_line(q1: DataFrame) -> DataFrame:
    """Q1 rows for the four weekdays with the most trips."""
    top = (q1.groupBy("pickup_weekday").agg(F.sum("trip_count").alias("weekday_trips"))
             .orderBy(F.desc("weekday_trips"), "pickup_weekday")
             .limit(LINE_TOP_WEEKDAYS))
    return q1.join(top, "pickup_weekday", "left_semi")


def feed_bar(q5: DataFrame) -> DataFrame:
    """The ten best-ranked location pairs, labelled ``PU→DO``."""
    return (q5.orderBy("pair_rank", "PULocationID", "DOLocationID").limit(BAR_TOP_PAIRS)
              .withColumn("location_pair",
                          F.concat_ws("→", F.col("PULocationID").cast("string"),
                                      F.col("DOLocationID").cast("string"))))


def feed_scatter(q2: DataFrame) -> DataFrame:
    """All Q2 bins, plus the first bin's correlation (the chart title)."""
    first = q2.orderBy("distance_bin").limit(1).select("distance_fare_corr").scalar()
    return q2.withColumn("first_bin_corr", first)


def feed_payment(q3: DataFrame) -> DataFrame:
    """C4: the twelve busiest Q3 slots, labelled ``L{loc}-H{hour}``."""
    return (q3.orderBy(F.desc("trip_count"), "PULocationID", "pickup_hour", "payment_desc")
              .limit(PAYMENT_TOP_SLOTS)
              .withColumn("slot", F.concat(F.lit("L"), F.col("PULocationID").cast("string"),
                                           F.lit("-H"), F.col("pickup_hour").cast("string"))))


def feed_tip(q4: DataFrame) -> DataFrame:
    """The first twelve Q4 rows (highest mean tip)."""
    return (q4.orderBy(F.desc("avg_tip"), "payment_desc", "distance_bucket", "VendorID")
              .limit(TIP_TOP_SEGMENTS))

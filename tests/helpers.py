"""Small builders for hand-written trip rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("VendorID", T.IntegerType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.DoubleType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("PULocationID", T.IntegerType()),
    T.StructField("DOLocationID", T.IntegerType()),
])

BASE = dt.datetime(2024, 1, 1)


def trip(minute=0, duration=10, vendor=1, passengers=1.0, distance=1.0, fare=10.0, tip=1.0,
         payment=1, pu=1, do=2, pickup_null=False):
    pickup = None if pickup_null else BASE + dt.timedelta(minutes=minute)
    dropoff = BASE + dt.timedelta(minutes=minute + duration)
    return (vendor, pickup, dropoff, passengers, distance, fare, tip, payment, pu, do)


def frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)

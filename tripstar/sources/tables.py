"""Readers for the given tables and the raw-trip view derived from them.

The trip pipeline reads one flat Parquet dataset of raw trips.  The test
data ships TPC-H-like tables instead, so ``raw_trips`` derives raw trips
from ``lineitem`` with integer arithmetic (identical rows in any engine).
Every derived row grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# The raw trip columns the pipeline names, in file order.
RAW_COLUMNS = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "passenger_count", "trip_distance", "fare_amount", "tip_amount",
    "payment_type", "PULocationID", "DOLocationID",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_raw(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    """Scan a raw trip Parquet file or directory.

    Reading a ``year=/month=`` leaf drops the partition columns; pass
    ``base_path`` to keep them.
    """
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(path)


# The derivation below follows the fixture definition: each lineitem row is
# one trip, and rows with l_orderkey % 100 = 0 appear twice (exact
# duplicates).  A single scan emits both copies through explode, instead of
# scanning lineitem a second time for the duplicate branch.
_TRIPS_FROM_LINEITEM = """
WITH k AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         (l_orderkey * 37 + l_linenumber * 101) % 44640 AS pu_min,
         CASE WHEN l_partkey % 97 = 0 THEN -5 ELSE 1 + l_partkey % 90 END AS dur_min,
         300 + (l_orderkey * l_linenumber) % 9000 AS fare_cents
  FROM {lineitem}),
t AS (
  SELECT
    l_orderkey,
    CAST(CASE WHEN l_suppkey % 10 = 0 THEN NULL WHEN l_suppkey % 10 < 4 THEN 1
              WHEN l_suppkey % 10 < 9 THEN 2 ELSE 6 END AS INT) AS VendorID,
    CASE WHEN l_orderkey % 199 = 0 THEN NULL
         ELSE timestampadd(MINUTE, CAST(pu_min AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')
    END AS tpep_pickup_datetime,
    timestampadd(MINUTE, CAST(pu_min + dur_min AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')
      AS tpep_dropoff_datetime,
    CASE l_orderkey % 20 WHEN 0 THEN NULL WHEN 1 THEN 0e0 WHEN 2 THEN 1.5e0 WHEN 3 THEN 2.5e0
         ELSE CAST(1 + l_linenumber % 5 AS DOUBLE) END AS passenger_count,
    CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 211 = 0 THEN 500e0
         ELSE CAST((l_partkey * 13 + l_linenumber * 7) % 2400 AS DOUBLE) / 100e0 END AS trip_distance,
    CASE WHEN l_partkey % 211 = 0 THEN CAST(-fare_cents AS DOUBLE) / 100e0
         WHEN l_orderkey % 41 = 0 THEN NULL
         WHEN l_orderkey % 37 = 0 THEN 0e0
         WHEN l_orderkey % 31 = 0 THEN CAST(-fare_cents AS DOUBLE) / 100e0
         ELSE CAST(fare_cents AS DOUBLE) / 100e0 END AS fare_amount,
    CASE WHEN l_orderkey % 43 = 0 THEN NULL
         WHEN l_orderkey % 8 < 5 THEN CAST((l_partkey * l_linenumber) % 1200 AS DOUBLE) / 100e0
         ELSE 0e0 END AS tip_amount,
    CAST(CASE l_orderkey % 8 WHEN 5 THEN 2 WHEN 6 THEN 3 + l_linenumber % 3 WHEN 7 THEN NULL
              ELSE 1 END AS BIGINT) AS payment_type,
    CAST(1 + l_suppkey % 4 AS INT) AS PULocationID,
    CAST(CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE 1 + l_partkey % 5 END AS INT) AS DOLocationID
  FROM k)
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
       fare_amount, tip_amount, payment_type, PULocationID, DOLocationID
FROM t
LATERAL VIEW explode(sequence(1, CASE WHEN l_orderkey % 100 = 0 THEN 2 ELSE 1 END)) copies AS copy_no
"""


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips derived from ``lineitem`` (the pipeline's input view)."""
    return spark.sql(_TRIPS_FROM_LINEITEM, lineitem=read_table(spark, sf_dir, "lineitem"))



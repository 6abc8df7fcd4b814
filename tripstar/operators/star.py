"""Star schema: three dimensions, one fact.

``dim_datetime`` has one row per pickup hour.  Every one of its descriptive
columns is a function of the hour's timestamp, so the distinct set is taken
over ``date_trunc('hour', pickup_ts)`` (one narrow column, collapsed
map-side) and the fact joins on ``(pickup_date, pickup_hour)`` — the same
match as joining on all six columns.

Keys
----
* ``stable`` (default): ``datetime_key = yyyyMMddHH`` as a number; loads of
  different months never reuse a key.
* ``parity``: ``datetime_key`` numbers the hours from 1 in (date, hour) order,
  as the published tables do.  The numbering restarts on every load, so it is
  only for a warehouse that holds one load.

The dimension joins for payment and trip category select nothing from the
right side and cannot fan out (the dimensions are distinct on the key), so
they are not executed at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions.buckets import payment_desc, time_of_day, trip_category_desc
from tripstar.plans.joins import lookup_join

# Published output columns, and the key columns that are checked.
DIM_DATETIME_COLUMNS = ("datetime_key", "pickup_date", "pickup_year", "pickup_month",
                        "pickup_hour", "pickup_weekday", "time_of_day")
FACT_COLUMNS = (
    "datetime_key", "payment_type", "distance_bucket", "VendorID", "PULocationID",
    "DOLocationID", "passenger_count_clean", "trip_distance_clean", "trip_duration_minutes",
    "fare_amount_clean", "tip_amount_clean", "total_revenue", "pickup_year", "pickup_month",
    "pickup_date",
)
PARTITION_COLUMNS = ("pickup_year", "pickup_month")
# table -> key columns checked for NULLs by the validation step
TABLE_KEYS = {
    "dim_datetime": ("datetime_key", "pickup_date"),
    "dim_payment": ("payment_type",),
    "dim_trip_category": ("distance_bucket",),
    "fact_trips": ("datetime_key", "payment_type", "distance_bucket"),
}


def dim_datetime(cleaned: DataFrame, keys: str = "stable") -> DataFrame:
    """One row per pickup hour present in the data (NULL pickup dropped)."""
    return dim_of_hours(cleaned.select(F.date_trunc("hour", "pickup_ts").alias("_h")).where(F.col("_h").isNotNull()).distinct(), keys)


def dim_of_hours(hours: DataFrame, keys: str = "stable") -> DataFrame:
    """D2 from the distinct hours ``(_h)``."""
    dim = hours.select(
        F.to_date("_h").alias("pickup_date"),
        F.year("_h").alias("pickup_year"),
        F.month("_h").alias("pickup_month"),
        F.hour("_h").alias("pickup_hour"),
        F.date_format("_h", "E").alias("pickup_weekday"),
    ).withColumn("time_of_day", time_of_day(F.col("pickup_hour")))
    if keys == "stable":
        key = F.date_format(F.to_timestamp(F.col("pickup_date")), "yyyyMMdd").cast("long") * 100 \
            + F.col("pickup_hour")
        dim = dim.withColumn("datetime_key", key)
    else:
        # One row per hour of the loaded period: a few thousand rows at most
        # for a month, so the single ordered window is bounded.
        dim = dim.withColumn("datetime_key",
                             F.row_number().over(Window.orderBy("pickup_date", "pickup_hour")))
    return dim.select(*DIM_DATETIME_COLUMNS)


def dim_payment(cleaned: DataFrame) -> DataFrame:
    """D3: distinct payment codes (after the NULL -> 0 default) with labels."""
    return (cleaned.select("payment_type").distinct()
                   .withColumn("payment_desc", payment_desc(F.col("payment_type"))))


def dim_trip_category(cleaned: DataFrame) -> DataFrame:
    """Distinct distance buckets with labels."""
    return (cleaned.select("distance_bucket").distinct()
                   .withColumn("trip_category_desc", trip_category_desc(F.col("distance_bucket"))))


def fact_trips(cleaned: DataFrame, dim_dt: DataFrame, written: bool = False) -> DataFrame:
    """One row per cleaned trip with its hour key (NULL pickup -> NULL key).
    ``written``: the dimension is a written table already."""
    keys = dim_dt.select("pickup_date", "pickup_hour", "datetime_key")
    joined = lookup_join(cleaned, keys, on=["pickup_date", "pickup_hour"], how="left", written=written)
    return joined.select(*FACT_COLUMNS)


@dataclass
class Star:
    dim_datetime: DataFrame
    dim_payment: DataFrame
    dim_trip_category: DataFrame
    fact_trips: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_datetime": self.dim_datetime, "dim_payment": self.dim_payment,
                "dim_trip_category": self.dim_trip_category, "fact_trips": self.fact_trips}


def build_star(cleaned: DataFrame, keys: str = "stable") -> Star:
    dt = dim_datetime(cleaned, keys)
    return Star(dt, dim_payment(cleaned), dim_trip_category(cleaned), fact_trips(cleaned, dt))


def validate_table(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """D6 for one table: rows ``(table_name, row_count, key_column, null_count)``
    from a single aggregate (one job per table, not one per check)."""
    agg = df.agg(F.count(F.lit(1)).alias("row_count"),
                 *[F.count_if(F.col(k).isNull()).alias(f"_n{i}") for i, k in enumerate(keys)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(k).alias("key_column"), F.col(f"_n{i}").alias("null_count"))
        for i, k in enumerate(keys)]))
    return agg.select(F.lit(name).alias("table_name"), "row_count", stacked.alias("_k")) \
              .select("table_name", "row_count", "_k.key_column", "_k.null_count")


def fact_summary(fact: DataFrame) -> DataFrame:
    """One row per (payment type, distance bucket): trips, and trips without an
    hour key.  The two small dimensions and the fact's validation follow from
    it, so the fact is read once for all of them."""
    return fact.groupBy("payment_type", "distance_bucket").agg(
        F.count(F.lit(1)).alias("trips"), F.count_if(F.col("datetime_key").isNull()).alias("no_key"))


def validate_fact(summary: DataFrame) -> DataFrame:
    """D6 for the fact, from its summary."""
    def trips_where(condition):
        return F.sum(F.when(condition, F.col("trips")).otherwise(0))

    nulls = {"datetime_key": F.sum("no_key"), "payment_type": trips_where(F.col("payment_type").isNull()),
             "distance_bucket": trips_where(F.col("distance_bucket").isNull())}
    zero = F.lit(0).cast("long")
    agg = summary.agg(F.coalesce(F.sum("trips"), zero).alias("row_count"),
                      *[F.coalesce(n, zero).alias(k) for k, n in nulls.items()])
    stacked = F.explode(F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_count")) for k in nulls]))
    return (agg.select(F.lit("fact_trips").alias("table_name"), "row_count", stacked.alias("_k"))
               .select("table_name", "row_count", "_k.key_column", "_k.null_count"))


def validate_star(tables: dict[str, DataFrame], raw: DataFrame | None = None,
                  raw_rows: DataFrame | None = None, summary: DataFrame | None = None) -> DataFrame:
    """Row and key-NULL counts for every table (the fact's from its summary,
    if given), plus the raw row count (counted from ``raw``, or given as a
    one-row frame ``raw_rows(n)``)."""
    parts = [validate_fact(summary) if name == "fact_trips" and summary is not None
             else validate_table(name, tables[name], keys)
             for name, keys in TABLE_KEYS.items() if name in tables]
    if raw is not None and raw_rows is None:
        raw_rows = raw.agg(F.count(F.lit(1)).alias("n"))
    if raw_rows is not None:
        parts.append(raw_rows.select(F.col("n").cast("long").alias("row_count"))
                        .select(F.lit("raw").alias("table_name"), "row_count",
                                F.lit(None).cast("string").alias("key_column"),
                                F.lit(None).cast("long").alias("null_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_load(raw: DataFrame, staged: DataFrame, fact: DataFrame, copies: str) -> DataFrame:
    """Whether a load lost or doubled rows: the raw rows, counted on their own,
    against the copies the dedupe counted, and the distinct rows against the
    fact rows that were written.  Rows ``(check, observed, expected, severity)``;
    a difference is a ``fail``."""
    def one(df: DataFrame, what) -> DataFrame:
        return df.agg(F.coalesce(what, F.lit(0)).cast("long").alias("n"))

    counts = {"raw": one(raw, F.count(F.lit(1))), "copies": one(staged, F.sum(copies)),
              "distinct": one(staged, F.count(F.lit(1))), "fact": one(fact, F.count(F.lit(1)))}
    row = raw.sparkSession.range(1).select(*[df.scalar().alias(name) for name, df in counts.items()])
    return load_checks(row)


def load_checks(row: DataFrame) -> DataFrame:
    """The checks of a load from its counts ``(raw, copies, distinct, fact)``."""
    checks = F.array(*[F.struct(F.lit(name).alias("check"), F.col(a).alias("observed"), F.col(b).alias("expected"),
                                F.when(F.col(a) == F.col(b), "pass").otherwise("fail").alias("severity"))
                       for name, a, b in (("raw rows are all counted by the dedupe", "copies", "raw"),
                                          ("distinct rows are all in the fact", "fact", "distinct"))])
    return row.select(F.explode(checks).alias("_c")).select("_c.*")

"""Cleaning rules declared by the profiling plan but absent from the ETL.

* X1 ``fix_future_pickups``: a pickup later than ``as_of`` is replaced by the
  median pickup of the valid trips with the same hour of day and day of
  week (discrete median of the epoch time).
* X2 ``impute_mode``: NULL categorical codes -> the column's most frequent
  value (ties -> the smallest), instead of the fixed 0 the ETL uses.
* X3 ``forward_fill``: a NULL timestamp takes the last non-NULL value before
  it, per vendor, in drop-off order (ties broken by the remaining columns).

X3 is written to stay balanced when one vendor holds a large share of the
trips: rows are range-partitioned on (vendor, order columns) into evenly sized
slices, filled inside each slice, and the value carried into a slice comes
from a small per-slice table (one row per vendor and slice).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstar.functions.quantiles import Quantile, exact_quantiles
from tripstar.plans.joins import lookup_join
from tripstar.session import staged_table

CATEGORICAL = ("VendorID", "payment_type", "PULocationID", "DOLocationID")


# X1 ------------------------------------------------------------------------
def fix_future_pickups(df: DataFrame, as_of: str, column: str = "tpep_pickup_datetime",
                       out: str = "pickup_fixed") -> DataFrame:
    ts = F.to_timestamp(column)
    limit = F.lit(as_of).cast("timestamp")
    keyed = df.withColumns({"_h": F.hour(ts), "_dow": F.dayofweek(ts), "_us": F.unix_micros(ts),
                            "_future": ts > limit})
    # one row per (hour, weekday): at most 168 rows, a proven broadcast bound
    medians = exact_quantiles(keyed.where(~F.col("_future")), [Quantile("_med", "_us", 0.5)],
                              by=["_h", "_dow"])
    joined = keyed.join(F.broadcast(medians), ["_h", "_dow"], "left")
    fixed = F.when(F.col("_future") & F.col("_med").isNotNull(),
                   F.timestamp_micros(F.col("_med").cast("long")).cast("timestamp_ntz")) \
             .otherwise(F.col(column))
    return joined.withColumn(out, fixed).drop("_h", "_dow", "_us", "_future", "_med")


# X2 ------------------------------------------------------------------------
def impute_mode(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """The counts per value are partial sums, so no task holds a column's
    values; ``max_by`` then picks per column."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    entries = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    # numbers order as numbers: the tie goes to the smallest value of the column's own type
    counts = (df.select(F.explode(F.array(*entries)).alias("e")).where("e.v IS NOT NULL")
                .groupBy("e.i", "e.v").agg(F.count(F.lit(1)).alias("n")))
    picks = [F.max_by(F.when(F.col("i") == i, F.col("v").cast(df.schema[c].dataType)),
                      F.when(F.col("i") == i, F.struct(F.col("n"), -F.col("v").try_cast("double")))).alias(c)
             for i, c in enumerate(columns)]
    modes = counts.agg(F.struct(*picks).alias("m"))
    with_modes = df.withColumn("_modes", modes.select("m").scalar())
    return with_modes.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_modes.{c}")) for c in columns}).drop("_modes")


# X3 ------------------------------------------------------------------------
def forward_fill(df: DataFrame, column: str = "tpep_pickup_datetime", by: str = "VendorID",
                 order: str = "tpep_dropoff_datetime", out: str = "pickup_filled",
                 slices: int | None = None) -> DataFrame:
    """Rows with NULL in ``by`` are a group like any other (struct keys compare
    NULL as equal)."""
    tie = [c for c in df.columns if c not in (by, order)]
    okey = [F.col(order), *[F.col(c) for c in tie]]
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Slice bounds come from a sample; the per-row fill and the per-slice table
    # must see the same slices, so the sliced rows are written once to the shared
    # folder (cutting the lineage as well).  The order is that of the columns
    # themselves: no second copy of a row travels with it.
    ranged = staged_table(df.withColumn("_g", F.struct(F.col(by)))
                            .repartitionByRange(slices, F.col("_g"), *okey)
                            .withColumn("_s", F.spark_partition_id()), "forward-fill")
    okey = [F.col(order), *[F.col(c) for c in tie]]
    inside = Window.partitionBy("_g", "_s").orderBy(*okey).rowsBetween(Window.unboundedPreceding, 0)
    filled = ranged.withColumn("_in", F.last(column, ignorenulls=True).over(inside))
    # last non-NULL value of each slice (NULL if none), then the value
    # carried into each slice from the slices before it: one row per
    # (group, slice), so the table is bounded by the slice count.
    last_of_slice = ranged.groupBy("_g", "_s").agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*okey))).alias("_last"))
    before = Window.partitionBy("_g").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_of_slice.select("_g", "_s", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    joined = lookup_join(filled, carry, on=["_g", "_s"], how="left")
    value = F.coalesce(F.col(column), F.col("_in"), F.col("_carry"))
    return joined.withColumn(out, value).drop("_g", "_s", "_in", "_carry")

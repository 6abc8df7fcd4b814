"""The query registry behind ``__spark_entry__``: one entry per operator.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the given tables (or from tables Spark derived from them), over all rows.

* source and profile entries are plans over the raw trips;
* cleaning, star and extension entries read the deduplicated rows, staged
  once per application and data folder; exact quantiles write their sliced
  values when the plan is built, so building these plans runs jobs;
* analytics entries and feeds read the warehouse written by the ETL job,
  as the analytics step does in production;
* sink entries write to a fresh folder under the shared work folder and
  read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.operators import clean, extensions, profile, star
from tripstar.plans import analytics, feeds
from tripstar.plans.etl import LOAD, read_warehouse, run_etl, stage
from tripstar.plans.warehouse import prepared, validation, warehouse
from tripstar.session import apply_pipeline_conf, scratch_path
from tripstar.sources import landing
from tripstar.sources.files import remove_tree
from tripstar.sources.sinks import write_csv, write_table
from tripstar.sources.tables import RAW_COLUMNS, raw_trips

RAW = list(RAW_COLUMNS)
# Fixed parameter of the registered future-pickup check: a moment inside
# the loaded month, so both sides of the comparison occur.
FUTURE_AS_OF = "2024-01-25 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    apply_pipeline_conf(spark)
    return raw_trips(spark, sf)


def _prepared(spark, sf):
    return prepared(spark, sf)


def _distinct(spark, sf):
    """T1 of the raw columns."""
    return _prepared(spark, sf).select(*RAW)


def _after_tip(spark, sf):
    prepared = _prepared(spark, sf)
    df = clean.clean_fare(prepared, clean.fare_bin_medians(prepared))
    return clean.clean_tip(clean.clean_passengers(df))


def _cleaned(spark, sf):
    return clean.finish(_prepared(spark, sf))


def _star(spark, sf) -> star.Star:
    return star.build_star(_cleaned(spark, sf), keys="parity")


def _wh(spark, sf):
    return warehouse(spark, sf)


def _q(name: str) -> Query:
    def run(spark, sf):
        t = _wh(spark, sf)
        return analytics.run_queries(t["fact_trips"], t["dim_datetime"], t["dim_payment"])[name]
    return run


def _profile(spark, sf):
    return profile.profile_frame(_raw(spark, sf))


def _cap(spark, sf):
    df = _after_tip(spark, sf)
    df = clean.with_stats(df, clean.global_stats(df))
    return clean.cap_distance(df, F.col("_stats")).drop("_stats")


def _impute(spark, sf):
    df = _after_tip(spark, sf)
    df = clean.with_stats(df, clean.global_stats(df))
    s = F.col("_stats")
    return clean.impute_medians(clean.cap_distance(df, s), s).drop("_stats")


def _land_raw(spark, sf):
    base = scratch_path(spark, "landing")
    landing.land_raw(_raw(spark, sf), base, 2024, 1)
    return landing.read_landed(spark, base)


def _landing_check(spark, sf):
    """The checks of a landed month; observed sizes depend on the file system."""
    base, raw = scratch_path(spark, "landing"), _raw(spark, sf)
    leaf = landing.land_raw(raw, base, 2024, 1)
    return landing.check_copy(spark, leaf, raw.count()).select("check", "threshold", "severity")


SAMPLED = 10_000


def _sample(spark, sf):
    """What can be said of any sample: its size, and that it holds no row more
    often than the raw data do."""
    raw = _raw(spark, sf)
    picked = landing.sample_n(raw, SAMPLED).groupBy(*RAW).agg(F.count(F.lit(1)).alias("picked"))
    there = raw.groupBy(*RAW).agg(F.count(F.lit(1)).alias("there"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in RAW]
    on = same[0]
    for c in same[1:]:
        on = on & c
    joined = picked.alias("p").join(there.alias("r"), on, "left")
    return joined.agg(F.sum("picked").alias("sampled_rows"),
                      F.count_if(F.coalesce("there", F.lit(0)) < F.col("picked")).alias("rows_not_in_source"))


# Two loads derived from the raw trips: the trips from pick-up location 1 and 2
# are January's file, the others are moved 20 days on and are February's, so
# February's file has strays of January and both have NULL pickups.
FIRST_LOAD, SECOND_LOAD, SHIFT_DAYS = 202401, 202402, 20


def two_load_frames(spark: SparkSession, sf: str) -> dict[int, DataFrame]:
    raw = _raw(spark, sf)
    moved = {c: F.expr(f"timestampadd(DAY, {SHIFT_DAYS}, {c})") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    first = F.col("PULocationID") <= 2
    return {FIRST_LOAD: raw.where(first), SECOND_LOAD: raw.where(~first).withColumns(moved)}


def _two_loads(spark, sf):
    """The warehouse after January, February, January again; and after February,
    January: trips by load and pickup month, with and without an hour key.  Each file
    is deduplicated once and loaded from its staged rows as often as the orders say."""
    folder, out = scratch_path(spark, "two-files"), []
    files = {load: stage(spark, raw, f"{folder}/{load}") for load, raw in two_load_frames(spark, sf).items()}
    for name, order in (("reload", (FIRST_LOAD, SECOND_LOAD, FIRST_LOAD)), ("reverse", (SECOND_LOAD, FIRST_LOAD))):
        path = scratch_path(spark, "two-loads")
        for load in order:
            run_etl(spark, files[load], path, load_month=load)
        t = read_warehouse(spark, path)
        hours = t["dim_datetime"].groupBy("datetime_key").agg(F.count(F.lit(1)).alias("hour_rows"))
        fact = t["fact_trips"].join(hours, "datetime_key", "left")
        out.append(fact.groupBy(F.lit(name).alias("loads"), F.col(LOAD).alias("load_month"), "pickup_year", "pickup_month")
                       .agg(F.count(F.lit(1)).alias("trips"), F.coalesce(F.sum("hour_rows"), F.lit(0)).alias("keyed_trips"),
                            F.sum("passenger_count_clean").alias("passengers")))
    remove_tree(spark, folder)
    return out[0].unionByName(out[1])


def dirty_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trips with NaN numbers and timestamps that cannot be read."""
    raw = _raw(spark, sf)
    nan = F.lit(float("nan"))
    return raw.withColumns({
        "passenger_count": F.when(F.col("passenger_count") == 2.5, nan).otherwise(F.col("passenger_count")),
        "trip_distance": F.when(F.col("trip_distance") == 500, nan).otherwise(F.col("trip_distance")),
        "tip_amount": F.when(F.col("tip_amount") == 0, nan).otherwise(F.col("tip_amount")),
        "tpep_pickup_datetime": F.when(F.col("passenger_count") == 1.5, F.lit("not a time"))
                                 .otherwise(F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")),
    })


def _dirty_profile(spark, sf):
    return profile.profile_frame(dirty_trips(spark, sf))


def _dynamic_overwrite(spark, sf):
    """Write the fact, then overwrite only the partitions of the rows with a
    pickup month: the NULL-pickup partition must survive untouched."""
    path = scratch_path(spark, "fact")
    fact = _star(spark, sf).fact_trips
    write_table(fact, path, star.PARTITION_COLUMNS)
    write_table(spark.read.parquet(path).where(F.col("pickup_month").isNotNull()),
                path + "_dated", star.PARTITION_COLUMNS, rebalance=False)
    write_table(spark.read.parquet(path + "_dated"), path, star.PARTITION_COLUMNS, rebalance=False)
    return spark.read.parquet(path).select(*star.FACT_COLUMNS)


def _export_csv(spark, sf):
    q1 = _q("q1_hour_weekday_volume_fare")(spark, sf)
    path = scratch_path(spark, "csv")
    write_csv(q1, path)
    return spark.read.option("header", True).schema(q1.schema).csv(path)


def _scan_star(spark, sf):
    t = _wh(spark, sf)
    parts = [t[name].agg(F.count(F.lit(1)).alias("row_count"))
                    .select(F.lit(name).alias("table_name"), "row_count")
             for name in ("fact_trips", "dim_datetime", "dim_payment")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def queries() -> dict[str, Query]:
    return {
        # sources, landing, gate
        "scan_raw": _raw,
        "land_raw": _land_raw,
        "landing_check": _landing_check,
        "gate_raw": lambda s, sf: landing.gate_raw(_raw(s, sf)),
        "sample_n": _sample,
        # profile
        "profile_duration": _profile,
        "schema_report": lambda s, sf: profile.schema_report(_profile(s, sf)),
        "profile_missing": lambda s, sf: profile.missing_report(_profile(s, sf)),
        "profile_stats": lambda s, sf: profile.numeric_stats(_profile(s, sf)),
        "profile_histogram": lambda s, sf: profile.distribution_report(_profile(s, sf)),
        "dq_duplicates": lambda s, sf: profile.duplicate_rows(_raw(s, sf)),
        "dq_issues": lambda s, sf: profile.simple_issues(_raw(s, sf)),
        "dq_iqr": lambda s, sf: profile.iqr_outliers(_raw(s, sf)),
        "dq_future": lambda s, sf: profile.future_pickups(_raw(s, sf), FUTURE_AS_OF),
        "dq_report": lambda s, sf: profile.issue_report(_raw(s, sf), FUTURE_AS_OF),
        "profile_dirty": lambda s, sf: profile.numeric_stats(_dirty_profile(s, sf)),
        "dq_dirty": lambda s, sf: profile.issue_report(dirty_trips(s, sf), FUTURE_AS_OF),
        # cleaning, one entry per step
        "clean_dedupe": _distinct,
        "clean_duration": lambda s, sf: clean.add_duration(_distinct(s, sf))
                                             .select(*RAW, "trip_duration_minutes"),
        "fare_medians": lambda s, sf: clean.fare_bin_medians(_prepared(s, sf)),
        "clean_fare": lambda s, sf: clean.clean_fare(_prepared(s, sf), clean.fare_bin_medians(_prepared(s, sf)))
                                         .select(*RAW, "distance_bin", "fare_amount_clean"),
        "clean_passengers": lambda s, sf: clean.clean_passengers(_distinct(s, sf))
                                               .select(*RAW, "passenger_count_clean"),
        "clean_tip": lambda s, sf: _after_tip(s, sf).select(*RAW, "fare_amount_clean", "tip_amount_clean"),
        "global_stats": lambda s, sf: clean.global_stats(_after_tip(s, sf)),
        "clean_distance": lambda s, sf: _cap(s, sf).select(*RAW, "trip_distance_clean"),
        "clean_impute": lambda s, sf: _impute(s, sf).select(*RAW, *clean.IMPUTED),
        "clean_defaults": lambda s, sf: clean.fill_categorical_defaults(_distinct(s, sf)),
        "derive_calendar": lambda s, sf: clean.derive_calendar(clean.add_duration(
            _distinct(s, sf))).select(
                *RAW, "pickup_date", "pickup_year", "pickup_month", "pickup_hour", "pickup_weekday"),
        "derive_buckets": lambda s, sf: _cleaned(s, sf).select(
            *RAW, "time_of_day", "total_revenue", "distance_bucket"),
        "clean_trips": lambda s, sf: _cleaned(s, sf).drop("pickup_ts", "dropoff_ts"),
        # star schema
        "dim_datetime": lambda s, sf: star.dim_datetime(_prepared(s, sf), keys="parity"),
        # codes only need T11, not the cleaning statistics
        "dim_payment": lambda s, sf: star.dim_payment(clean.fill_categorical_defaults(_distinct(s, sf))),
        "dim_trip_category": lambda s, sf: star.dim_trip_category(_cleaned(s, sf)),
        "fact_trips": lambda s, sf: _star(s, sf).fact_trips,
        "validate_star": lambda s, sf: validation(s, sf),
        "scan_star": _scan_star,
        "roundtrip_fact": lambda s, sf: _wh(s, sf)["fact_trips"].select(*star.FACT_COLUMNS),
        "dynamic_overwrite": _dynamic_overwrite,
        "two_loads": _two_loads,
        "export_csv": _export_csv,
        # business queries
        "q1_hour_weekday_volume_fare": _q("q1_hour_weekday_volume_fare"),
        "q2_distance_fare_correlation": _q("q2_distance_fare_correlation"),
        "q3_payment_preference_time_location": _q("q3_payment_preference_time_location"),
        "q4_avg_tip_by_segments": _q("q4_avg_tip_by_segments"),
        "q5_top_location_pairs": _q("q5_top_location_pairs"),
        # chart feeds
        "feed_line": lambda s, sf: feeds.feed_line(_q("q1_hour_weekday_volume_fare")(s, sf)),
        "feed_bar": lambda s, sf: feeds.feed_bar(_q("q5_top_location_pairs")(s, sf)),
        "feed_scatter": lambda s, sf: feeds.feed_scatter(_q("q2_distance_fare_correlation")(s, sf)),
        "feed_payment": lambda s, sf: feeds.feed_payment(_q("q3_payment_preference_time_location")(s, sf)),
        "feed_tip": lambda s, sf: feeds.feed_tip(_q("q4_avg_tip_by_segments")(s, sf)),
        # extensions declared by the profiling plan
        **_extensions(),
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 end to end from the raw trips."""
    s = _star(spark, sf_dir)
    return analytics.q1_hour_weekday_volume_fare(s.fact_trips, s.dim_datetime)


def _extensions() -> dict[str, Query]:
    return {
        "ext_future_fix": lambda s, sf: extensions.fix_future_pickups(
            _distinct(s, sf), FUTURE_AS_OF),
        "ext_mode_impute": lambda s, sf: extensions.impute_mode(_distinct(s, sf)),
        "ext_ffill": lambda s, sf: extensions.forward_fill(_distinct(s, sf)),
    }

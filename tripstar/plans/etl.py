"""The ETL job: raw trips -> cleaned -> star schema on disk -> validation.

Loads
-----
One run is one *load* (``load_month``, for instance 202401).  ``dim_datetime``
and ``fact_trips`` are partitioned by load month first and by pickup year and
month below it, and a run replaces its own load month as a whole.  A month's
file always has a few stray pickups of other months; they stay with the load
they came in, so no load touches another's rows, in whatever order loads run
or run again.  An hour that occurs in two loads has one key (``stable`` keys are
a function of the hour), and :func:`read_warehouse` shows it once.

Passes over the data
--------------------
1. dedupe (T1) + timestamps, duration, distance bin (T2-T4), written once as
   a staged Parquet table in the shared work folder, with the columns that later
   passes read.  This is the only shuffle of rows and the only scan of the raw
   rows; the raw, copy and distinct counts are observed while it runs.  The staged
   table cuts the lineage (a lost executor re-reads files instead of recomputing
   the dedupe), and a file that is loaded several times can be staged once
   (:func:`stage`).
2. one scan of the staged rows counts the values that all statistics and the date
   dimension follow from (:func:`tripstar.operators.clean.value_counts`).
3. a second scan of the staged rows writes the fact; the medians are a small
   written lookup, the global statistics a scalar subquery.  A load of few months
   (``FEW_MONTHS``) is written as it is scanned; the rows of more are shuffled by
   month first, so that not every task writes a file into every month.
4. one scan of the new fact gives its summary, from which the load check, the two
   small dimensions and the fact's validation follow.  The summary is kept beside
   the fact, so a later load folds it in and reads no fact row of this one.

Publishing
----------
A load is written to a fresh folder, checked there, and put in place by renames
(:func:`tripstar.sources.files.swap_in`).  Until then, and for good if a check
fails, readers find the former rows.  Other loads are never touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstar.operators import clean, star
from tripstar.session import scratch_path
from tripstar.sources.files import exists, list_names, remove_tree, swap_in
from tripstar.sources.sinks import write_json, write_table

TABLES = ("dim_datetime", "dim_payment", "dim_trip_category", "fact_trips")
STAGED_COLUMNS = ("VendorID", "passenger_count", "trip_distance", "fare_amount", "tip_amount", "payment_type", "PULocationID",
                  "DOLocationID", "pickup_ts", "trip_duration_minutes", "distance_bin", clean.COPIES)
FEW_MONTHS = 3
LOAD = "load_month"
SUMMARY = "_fact_summary"
VALIDATION_SCHEMA = "table_name string, row_count long, key_column string, null_count long"
CHECK_SCHEMA = "check string, observed long, expected long, severity string"


class LoadFailed(RuntimeError):
    """A load that lost or doubled rows."""


@dataclass
class EtlResult:
    out_dir: str
    validation: DataFrame
    load_check: DataFrame


@dataclass
class Staged:
    """The deduplicated rows of one file (T1-T4), written, and its ``raw``, ``copies``
    and ``distinct`` counts."""
    rows: DataFrame
    counts: dict[str, int]


def read_warehouse(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The written tables (S2).  Load month and pickup year and month come from
    the folder names.  All columns of an hour follow from its key, so an hour
    that several loads have is one row."""
    tables = {name: spark.read.parquet(f"{out_dir}/{name}") for name in TABLES}
    if len(loads(spark, out_dir)) > 1:
        tables["dim_datetime"] = tables["dim_datetime"].drop(LOAD).distinct()
    else:
        tables["dim_datetime"] = tables["dim_datetime"].drop(LOAD)
    return tables


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose the warehouse tables to ad-hoc SQL as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def loads(spark: SparkSession, out_dir: str) -> list[int]:
    """Load months that the fact table holds."""
    prefix = f"{LOAD}="
    return sorted(int(n[len(prefix):]) for n in list_names(spark, f"{out_dir}/fact_trips") if n.startswith(prefix))


def run_etl(spark: SparkSession, raw: DataFrame | Staged, out_dir: str, keys: str = "stable",
            accuracy: int | None = None, validate: bool = True, load_month: int = 0) -> EtlResult:
    """Load ``raw``, or what :func:`stage` made of it, as ``load_month`` (0: a warehouse
    of one unnamed load)."""
    if keys == "parity" and set(loads(spark, out_dir)) - {load_month}:
        raise ValueError(f"{out_dir} holds other loads: parity keys start at 1 in each load and would "
                         "mix their hours; use stable keys")
    scratch, new = scratch_path(spark, "etl"), f"{out_dir}/_new-{uuid.uuid4().hex[:12]}"
    try:
        return _run(spark, raw, out_dir, keys, accuracy, validate, int(load_month), scratch, new)
    finally:
        remove_tree(spark, scratch)
        remove_tree(spark, new)


def stage(spark: SparkSession, raw: DataFrame, path: str) -> Staged:
    """Deduplicate a file into the folder ``path``, which is the caller's to remove:
    rows and counts can be loaded more than once."""
    seen, kept = Observation("raw"), Observation("distinct")
    prepared = clean.prepare(raw.observe(seen, F.count(F.lit(1)).alias("raw")), keep_copies=True)
    # Dedupe compares every raw column; only those that later steps read are staged.
    prepared = prepared.select(*[c for c in prepared.columns if c in STAGED_COLUMNS])
    write_table(prepared.observe(kept, F.count(F.lit(1)).alias("distinct"),
                                 F.coalesce(F.sum(clean.COPIES), F.lit(0)).alias("copies")), path)
    counts = {k: int(v) for k, v in {**seen.get, **kept.get}.items()}
    if counts["raw"] != counts["copies"]:
        # a task that ran twice (lost executor) is observed twice: count again
        again = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum(clean.COPIES), F.lit(0)).alias("c")).first()
        counts = {"raw": raw.count(), "distinct": int(again["d"]), "copies": int(again["c"])}
    return Staged(spark.read.parquet(path), counts)


def _summaries(spark: SparkSession, out_dir: str, load_month: int) -> DataFrame | None:
    """The fact summaries of the other loads.  A load that was written without one
    is summarised from its fact, once."""
    found = None
    for month in loads(spark, out_dir):
        path = f"{out_dir}/{SUMMARY}/{LOAD}={month}"
        if month != load_month:
            if not exists(spark, path):
                write_table(star.fact_summary(spark.read.parquet(f"{out_dir}/fact_trips/{LOAD}={month}")), path)
            one = spark.read.parquet(path)
            found = one if found is None else found.unionByName(one)
    return found


def _run(spark, raw, out_dir, keys, accuracy, validate, load_month, scratch, new) -> EtlResult:
    given = raw if isinstance(raw, Staged) else stage(spark, raw, f"{scratch}/trips")
    staged, counts = given.rows, dict(given.counts)

    def put(df: DataFrame, path: str, partition_cols: Sequence[str] = (), rebalance: bool = True) -> DataFrame:
        return spark.read.parquet(write_table(df, path, partition_cols, overwrite="static", rebalance=rebalance))

    values = put(clean.value_counts(staged), f"{scratch}/values")
    dim_dt = put(star.dim_of_hours(clean.pickup_hours(values), keys), f"{new}/dim_datetime", star.PARTITION_COLUMNS)
    months = dim_dt.select(*star.PARTITION_COLUMNS).distinct().count()
    if accuracy is None:
        medians = put(clean.medians_of_values(values), f"{scratch}/medians")
        stats = put(clean.stats_of_values(values, medians), f"{scratch}/stats")
    else:
        medians, stats = put(clean.fare_bin_medians(staged, accuracy), f"{scratch}/medians"), None
    cleaned = clean.finish(staged, accuracy, medians, stats)
    fact = put(star.fact_trips(cleaned, dim_dt, written=True), f"{new}/fact_trips", star.PARTITION_COLUMNS,
               rebalance=months > FEW_MONTHS)
    own = put(star.fact_summary(fact), f"{new}/{SUMMARY}")

    counts["fact"] = int(own.agg(F.coalesce(F.sum("trips"), F.lit(0))).first()[0])
    names = ("raw", "copies", "distinct", "fact")
    row = spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))
    check = spark.createDataFrame(star.load_checks(row).collect(), CHECK_SCHEMA)
    write_json(check, f"{out_dir}/_load_check/{LOAD}={load_month}")
    failed = [r.asDict() for r in check.where("severity = 'fail'").collect()]
    if failed:
        raise LoadFailed(f"load {load_month}: {failed}")

    others = _summaries(spark, out_dir, load_month)
    summary = own if others is None else own.unionByName(others)
    dims = {"dim_payment": star.dim_payment(summary), "dim_trip_category": star.dim_trip_category(summary)}
    written = {name: put(df.coalesce(1), f"{new}/{name}") for name, df in dims.items()}
    # One row for each payment type and bucket of a load: a few, so they travel.
    summary = spark.createDataFrame(summary.collect(), summary.schema)
    tables = {**written, "dim_datetime": _all_hours(spark, out_dir, load_month, dim_dt)}
    found = None
    if validate:
        raw_rows = spark.createDataFrame([(counts["copies"],)], "n long")
        found = star.validate_star({**tables, "fact_trips": fact}, raw_rows=raw_rows, summary=summary).collect()
    swap_in(spark, [(f"{new}/{name}", f"{out_dir}/{name}/{LOAD}={load_month}") for name in ("dim_datetime", "fact_trips", SUMMARY)]
            + [(f"{new}/{name}", f"{out_dir}/{name}") for name in dims], f"{new}/replaced")
    validation = check
    if validate:
        write_json(spark.createDataFrame(found, VALIDATION_SCHEMA), f"{out_dir}/_validation")
        validation = spark.read.schema(VALIDATION_SCHEMA).json(f"{out_dir}/_validation")
    return EtlResult(out_dir, validation, check)


def _all_hours(spark: SparkSession, out_dir: str, load_month: int, own: DataFrame) -> DataFrame:
    """The date dimension as readers will see it once the load is in place."""
    both = own
    for month in set(loads(spark, out_dir)) - {load_month}:
        both = both.unionByName(spark.read.parquet(f"{out_dir}/dim_datetime/{LOAD}={month}"))
    return both if both is own else both.distinct()

"""Profiling of raw trips (P1-P16), as Spark aggregates.

Every report is one (or two) aggregate passes producing a single wide row,
then unpivoted into report rows: the data is never pulled to the driver and
the number of jobs does not grow with the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.functions.histogram import counted_values, histogram, histogram_of_counts
from tripstar.functions.money import pct_of
from tripstar.functions.quantiles import Quantile, exact_quantiles
from tripstar.session import staged_table

# Preferred histogram columns, report labels and their decimals.
KEY_COLUMNS = ("trip_distance", "fare_amount", "passenger_count", "tip_amount",
               "trip_duration_minutes")
HISTOGRAM_BINS = 50
ISSUES = (
    ("Duplicate rows", 2),
    ("Negative fare amount", 4),
    ("Zero passenger count", 2),
    ("Passenger count non-integer", 2),
    ("Trip distance outliers (IQR)", 2),
    ("Future pickup timestamps", 4),
    ("Tip greater than fare", 4),
)
ISSUE_SCHEMA = "position int, issue string, n long, pct double, display string"
SAMPLE_CHARS = 50
IQR_FACTOR = 1.5


def value_of(df: DataFrame, name: str) -> Column:
    """A numeric column as DOUBLE with NaN as missing, as the reports count it."""
    x = F.col(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(x), x)
    return x


def profile_frame(raw: DataFrame) -> DataFrame:
    """Timestamps parsed (NULL where they cannot be read) and a
    fractional duration in minutes."""
    df = raw
    if "tpep_pickup_datetime" in df.columns and "tpep_dropoff_datetime" in df.columns:
        pickup = F.unix_micros(F.col("tpep_pickup_datetime").try_cast("timestamp"))
        dropoff = F.unix_micros(F.col("tpep_dropoff_datetime").try_cast("timestamp"))
        df = df.withColumn("trip_duration_minutes", (dropoff - pickup) / F.lit(60_000_000.0))
    return df


def _unpivot_rows(agg: DataFrame, rows: Sequence[tuple[str, dict[str, Column]]],
                  fields: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate into one output row per entry of ``rows``
    (in column order; the reports are one row per column, so sorting them
    is free)."""
    structs = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"),
                        *[exprs[f].alias(f) for f in fields])
               for i, (name, exprs) in enumerate(rows, start=1)]
    return agg.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*").orderBy("position")


def _schema_aggs(df: DataFrame) -> list[Column]:
    return [F.min(c).alias(f"_m{i}") for i, c in enumerate(df.columns)]


def _schema_rows(agg: DataFrame, schema: T.StructType) -> DataFrame:
    rows = [(f.name, {"data_type": F.lit(f.dataType.simpleString()),
                      "sample_value": F.coalesce(
                          F.substring(F.col(f"_m{i}").cast("string"), 1, SAMPLE_CHARS),
                          F.lit("NaN"))})
            for i, f in enumerate(schema.fields)]
    return _unpivot_rows(agg, rows, ["data_type", "sample_value"])


def schema_report(df: DataFrame) -> DataFrame:
    """Column, type, a sample value cut to 50 characters ("NaN" if none).

    The sample is the smallest non-null value, so the report is
    deterministic (file order is not a property of a distributed scan).
    """
    return _schema_rows(df.agg(*_schema_aggs(df)), df.schema)


def _is_missing(f: T.StructField) -> Column:
    c = F.col(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _rows_agg() -> Column:
    return F.count(F.lit(1)).alias("_rows")


def _missing_aggs(df: DataFrame) -> list[Column]:
    return [F.count_if(_is_missing(f)).alias(f"_n{i}") for i, f in enumerate(df.schema.fields)]


def _missing_rows(agg: DataFrame, schema: T.StructType) -> DataFrame:
    rows = [(f.name, {"missing_count": F.col(f"_n{i}"),
                      "missing_pct": pct_of(F.col(f"_n{i}"), F.col("_rows"))})
            for i, f in enumerate(schema.fields)]
    # Most missing first
    return _unpivot_rows(agg, rows, ["missing_count", "missing_pct"]) \
        .orderBy(F.desc("missing_pct"), "position")


def missing_report(df: DataFrame) -> DataFrame:
    """NULL (and NaN) count and percentage per column."""
    return _missing_rows(df.agg(_rows_agg(), *_missing_aggs(df)), df.schema)


def numeric_columns(df: DataFrame) -> list[str]:
    """P5."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _stats_aggs(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    aggs = []
    for i, c in enumerate(cols):
        x = value_of(df, c)
        aggs += [F.avg(x).alias(f"_a{i}"), F.stddev_samp(x).alias(f"_s{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    return aggs


def _median_specs(df: DataFrame, cols: Sequence[str]) -> list[Quantile]:
    return [Quantile(f"_q{i}", value_of(df, c), 0.5, "cont") for i, c in enumerate(cols)]


def _stats_rows(agg: DataFrame, cols: Sequence[str], medians: DataFrame, scale: int) -> DataFrame:
    med = medians.select(F.struct(*[f"_q{i}" for i in range(len(cols))]).alias("m")).scalar()
    agg = agg.withColumn("_med", med)
    rows = [(c, {"mean": F.round(F.col(f"_a{i}"), scale),
                 "median": F.round(F.col(f"_med._q{i}"), scale),
                 "std": F.round(F.col(f"_s{i}"), scale),
                 "min": F.round(F.col(f"_lo{i}"), scale),
                 "max": F.round(F.col(f"_hi{i}"), scale)})
            for i, c in enumerate(cols)]
    return _unpivot_rows(agg, rows, ["mean", "median", "std", "min", "max"])


def numeric_stats(df: DataFrame, scale: int = 2) -> DataFrame:
    """Mean, median, sample std, min, max per numeric column (rounded)."""
    cols = numeric_columns(df)
    return _stats_rows(df.agg(*_stats_aggs(df, cols)), cols, exact_quantiles(df, _median_specs(df, cols)), scale)


def histogram_columns(df: DataFrame) -> list[str]:
    """The key columns present, else the first five numeric ones."""
    present = [c for c in KEY_COLUMNS if c in df.columns]
    return present or numeric_columns(df)[:5]


def distribution_report(df: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histograms of the key columns."""
    columns = histogram_columns(df)
    return histogram(df.select(*[value_of(df, c).alias(c) for c in columns]), columns, bins)


# P9-P16 data-quality issues -------------------------------------------------
def _issue_rows(agg: DataFrame, entries: Sequence[tuple[str, Column]]) -> DataFrame:
    decimals = dict(ISSUES)
    position = {name: i for i, (name, _) in enumerate(ISSUES, start=1)}
    structs = []
    if not entries:  # no column of these issues is present
        return agg.sparkSession.createDataFrame([], ISSUE_SCHEMA)
    for name, n in entries:
        pct = pct_of(n, F.col("_rows"), decimals[name])
        shown = F.concat(n.cast("string"), F.lit(" ("),
                         pct.cast(f"decimal(38,{decimals[name]})").cast("string"), F.lit("%)"))
        structs.append(F.struct(F.lit(position[name]).alias("position"), F.lit(name).alias("issue"),
                                n.cast("long").alias("n"), pct.alias("pct"), shown.alias("display")))
    return agg.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*").orderBy("position")


def _duplicates(df: DataFrame) -> DataFrame:
    """One row ``(_rows, _dups)``: rows beyond the first copy (NULLs equal).

    ``count(*) - count(distinct rows)`` via a grouped count: copies collapse
    map-side, so a heavily repeated row does not load one task.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    agg = groups.agg(F.sum("_c").alias("_rows"), F.sum(F.col("_c") - 1).alias("_dups"))
    return agg.select(F.coalesce("_rows", F.lit(0)).alias("_rows"),
                      F.coalesce("_dups", F.lit(0)).alias("_dups"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """P9."""
    return _issue_rows(_duplicates(df), [("Duplicate rows", F.col("_dups"))])


def _non_integer(c: Column) -> Column:
    return (c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))) | (c != F.rint(c)))


def _simple(df: DataFrame) -> list[tuple[str, str, Column]]:
    """(issue, aggregate name, condition) for the issues whose columns are present."""
    rules = [
        ("Negative fare amount", "_neg_fare", ("fare_amount",), lambda fare: fare < 0),
        ("Zero passenger count", "_zero_pass", ("passenger_count",), lambda n: n == 0),
        ("Passenger count non-integer", "_non_int", ("passenger_count",), _non_integer),
        ("Tip greater than fare", "_tip_gt_fare", ("tip_amount", "fare_amount"), lambda tip, fare: tip > fare),
    ]
    return [(issue, name, rule(*[value_of(df, c) for c in needs]))
            for issue, name, needs, rule in rules if set(needs) <= set(df.columns)]


def simple_issues(df: DataFrame) -> DataFrame:
    """P10, P11, P12, P15 in one aggregate, for the columns that are present."""
    rules = _simple(df)
    return _issue_rows(df.agg(_rows_agg(), *[F.count_if(rule).alias(name) for _, name, rule in rules]), [(issue, F.col(name)) for issue, name, _ in rules])


def _iqr_specs(df: DataFrame, column: str) -> list[Quantile]:
    x = value_of(df, column)
    return [Quantile("_iq1", x, 0.25, "cont"), Quantile("_iq3", x, 0.75, "cont")]


def _with_quartiles(df: DataFrame, quartiles: DataFrame) -> DataFrame:
    return df.withColumn("_q", quartiles.select(F.struct("_iq1", "_iq3").alias("s")).scalar())


def _outside(x: Column) -> Column:
    """Beyond the whiskers of the quartiles ``_q``."""
    q1, q3 = F.col("_q._iq1"), F.col("_q._iq3")
    iqr = q3 - q1
    return (x < q1 - F.lit(IQR_FACTOR) * iqr) | (x > q3 + F.lit(IQR_FACTOR) * iqr)


def iqr_outliers(df: DataFrame, column: str = "trip_distance") -> DataFrame:
    """Values outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] (interpolated quartiles)."""
    values = _with_quartiles(df.select(value_of(df, column).alias("_x")), exact_quantiles(df, _iqr_specs(df, column)))
    agg = values.agg(_rows_agg(), F.count_if(_outside(F.col("_x"))).alias("_out"))
    return _issue_rows(agg, [("Trip distance outliers (IQR)", F.col("_out"))])


def _as_of(as_of: str | Column | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, str):
        return F.lit(as_of).cast("timestamp")
    return as_of


def _is_future(as_of: str | Column | None) -> Column:
    return F.col("tpep_pickup_datetime").try_cast("timestamp") > _as_of(as_of)


def future_pickups(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """Pickups later than ``as_of`` (default: the query's current time)."""
    agg = df.agg(_rows_agg(), F.count_if(_is_future(as_of)).alias("_future"))
    return _issue_rows(agg, [("Future pickup timestamps", F.col("_future"))])


def issue_report(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """The seven issues in report order, each if its columns are present.
    Two scans: the quartiles, and the duplicate groups."""
    return _issues(df, as_of, None)


def _issues(df: DataFrame, as_of: str | Column | None, quartiles: DataFrame | None) -> DataFrame:
    """All issues from the duplicate groups: a condition on a row's values holds for
    all its copies, so a group counts with its number of copies and the rows are not
    read again.  The quartiles are computed unless they are given."""
    entries = [("Duplicate rows", "_dups", None), *_simple(df)]
    if "tpep_pickup_datetime" in df.columns:
        entries.append(("Future pickup timestamps", "_future", _is_future(as_of)))
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    if "trip_distance" in df.columns:
        groups = _with_quartiles(groups, exact_quantiles(df, _iqr_specs(df, "trip_distance")) if quartiles is None else quartiles)
        entries.append(("Trip distance outliers (IQR)", "_out", _outside(value_of(df, "trip_distance"))))

    def total(copies: Column, name: str) -> Column:
        return F.coalesce(F.sum(copies), F.lit(0)).alias(name)

    agg = groups.agg(total(F.col("_c"), "_rows"), total(F.col("_c") - 1, "_dups"),
                     *[total(F.when(rule, F.col("_c")), name) for _, name, rule in entries if rule is not None])
    return _issue_rows(agg, [(issue, F.col(name)) for issue, name, _ in entries])


# The whole profile with shared passes ---------------------------------------
def profile_reports(df: DataFrame, as_of: str | Column | None = None,
                    bins: int = HISTOGRAM_BINS) -> dict[str, DataFrame]:
    """All reports from three scans of ``df``: one aggregate for samples, NULL counts
    and statistics; the table (column, value, count), from which the medians, the IQR
    quartiles and the histograms follow; the duplicate groups, which carry all issue
    counts.  The first two are written when this is called.
    """
    cols, shown = numeric_columns(df), histogram_columns(df)
    measured = list(dict.fromkeys([*cols, *shown, *[c for c in ("trip_distance",) if c in df.columns]]))
    overview = staged_table(df.agg(_rows_agg(), *_schema_aggs(df), *_missing_aggs(df), *_stats_aggs(df, cols)), "profile")
    values = staged_table(counted_values(df.select(*[value_of(df, c).alias(c) for c in measured]), measured), "profile-values") \
        if measured else df.sparkSession.createDataFrame([], "column_name string, x double, n long")

    def at(name: str, column: str, q: float) -> Quantile:
        return Quantile(name, F.when(F.col("column_name") == column, F.col("x")), q, "cont")

    specs = [at(f"_q{i}", c, 0.5) for i, c in enumerate(cols)]
    if "trip_distance" in df.columns:
        specs += [at("_iq1", "trip_distance", 0.25), at("_iq3", "trip_distance", 0.75)]
    # one row, written once: nothing stays cached in executors
    quant = staged_table(exact_quantiles(values, specs, weight="n"), "profile-quantiles")
    return {
        "schema": _schema_rows(overview, df.schema),
        "missing": _missing_rows(overview, df.schema),
        "statistics": _stats_rows(overview, cols, quant, 2),
        "histograms": histogram_of_counts(values.where(F.col("column_name").isin(shown)), bins),
        "issues": _issues(df, as_of, quant),
    }

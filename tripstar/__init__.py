"""tripstar: a Spark-native trip warehouse.

Raw trip Parquet is gated and profiled, cleaned in a fixed order, modelled
as a star schema (three dimensions, one fact) written as partitioned
Parquet, and queried with five business queries plus the data feeds behind
their charts.  Every step is a lazy DataFrame / Spark SQL plan; there are no
Python UDFs.

Layout
------
``sources``    table readers, raw-trip fixture view, landing, gate, sinks
``functions``  column-level building blocks (exact quantiles, money averages,
               calendar buckets, histogram bins, percentages)
``operators``  DataFrame -> DataFrame steps: cleaning, star schema, profile,
               extensions
``plans``      whole jobs: ETL, analytics queries, chart feeds, size-checked
               joins, the per-session warehouse used by the query registry
``streaming``  intentionally empty (the pipeline has no streams)
"""

from tripstar.session import build_session, work_dir

__all__ = ["build_session", "work_dir"]

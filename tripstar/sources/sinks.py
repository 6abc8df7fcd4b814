"""Sinks: partitioned Parquet tables, CSV exports, JSON summaries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Files that a task of a partitioned write keeps open.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 8


@contextmanager
def _open_files(spark: SparkSession) -> Iterator[None]:
    """A task writes to several partitions at once, rather than sort (and spill)
    its rows by partition; beyond ``OPEN_FILES`` partitions it sorts the rest."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def write_table(df: DataFrame, path: str, partition_cols: Sequence[str] = (),
                mode: str = "overwrite", overwrite: str = "dynamic", rebalance: bool = True) -> str:
    """Parquet table, optionally partitioned.

    ``overwrite`` is set on the write itself, so the result does not depend on
    the session: "dynamic" replaces only the partitions present in ``df`` (S6),
    "static" replaces everything under ``path``.  A partitioned write is
    rebalanced on the partition columns: adaptive execution splits a large
    partition over tasks and merges small ones, instead of every task writing a
    file into every partition.  Rows read from files that lie by these partitions,
    or rows of few partitions, need no such shuffle (``rebalance=False``).
    """
    if partition_cols and rebalance:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode(mode).format("parquet").option("partitionOverwriteMode", overwrite)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with _open_files(df.sparkSession):
        writer.save(path)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Query result as CSV with a header (S7).  ``single_file`` puts all rows
    into one task: only for results with a bound (query outputs)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """Small summaries (validation) as JSON lines."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path

"""Equal-width histograms with the bin rule of the usual array libraries.

For ``bins`` bins over ``[lo, hi]`` (NULLs dropped; lo = hi widened to
lo - 0.5 .. hi + 0.5):

* edges ``e_i = lo + i * (hi - lo) / bins`` for ``i < bins`` and
  ``e_bins = hi``;
* the first guess is ``trunc((x - lo) / (hi - lo) * bins)``, with ``x = hi``
  falling into the last bin;
* the guess is moved down one bin if ``x < e_i`` and up one bin if
  ``x >= e_(i+1)`` (except for the last bin), so edge values land exactly
  where the edges say despite rounding in the first guess.

Plan: one aggregate for the ranges of all columns (one row per column),
one pass that unpivots the values to ``(column_name, x)``, joins the ranges
(broadcast: one row per column) and counts per ``(column_name, bin)`` with a
partial aggregate.  The output has every bin of every non-empty column,
empty bins with count 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    step = (hi - lo) / F.lit(float(bins))
    return F.when(i == F.lit(bins), hi).otherwise(i.cast("double") * step + lo)


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """The bin of ``x`` (0-based); edges as in the module docstring."""
    step = (hi - lo) / F.lit(float(bins))
    guess = F.least((((x - lo) / (hi - lo)) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    # guess <= bins - 1, so its lower edge is never the special last edge
    down = guess - (x < guess.cast("double") * step + lo).cast("int")
    up = (x >= _edge(down + 1, lo, hi, bins)) & (down != F.lit(bins - 1))
    return down + up.cast("int")


def _unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (df.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"))
                for c in columns])).alias("_e"))
              .select("_e.*"))


def value_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per non-empty column: ``(column_name, lo, hi)``, widened
    when the column is constant."""
    agg = df.agg(*[F.struct(F.min(F.col(c).cast("double")).alias("lo"),
                            F.max(F.col(c).cast("double")).alias("hi")).alias(f"_r{i}")
                   for i, c in enumerate(columns)])
    rows = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_r{i}.lo").alias("lo"),
                 F.col(f"_r{i}.hi").alias("hi"))
        for i, c in enumerate(columns)])).alias("_g")).select("_g.*").where(F.col("lo").isNotNull())
    return _widened(rows)


def _widened(ranges: DataFrame) -> DataFrame:
    same = F.col("lo") == F.col("hi")
    return ranges.select("column_name",
                         F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                         F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))


def counted_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, x, n)``: how often each value of each column occurs (NULLs
    dropped).  A task ships a distinct value once."""
    values = _unpivot(df, columns).where(F.col("x").isNotNull())
    return values.groupBy("column_name", "x").agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Rows ``(column_name, bin, bin_lo, bin_hi, count)``."""
    columns = list(columns)
    ranges = value_ranges(df, columns)
    values = _unpivot(df, columns).where(F.col("x").isNotNull())
    return _binned(values.withColumn("n", F.lit(1).cast("long")), ranges, bins)


def histogram_of_counts(values: DataFrame, bins: int = 50) -> DataFrame:
    """The same histogram from the table of :func:`counted_values`."""
    ranges = values.groupBy("column_name").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    return _binned(values, _widened(ranges), bins)


def _binned(values: DataFrame, ranges: DataFrame, bins: int) -> DataFrame:
    # ``ranges`` has one row per column: a proven broadcast bound.
    counts = (values.join(F.broadcast(ranges), "column_name")
                    .select("column_name", "n",
                            bin_index(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"))
                    .groupBy("column_name", "bin").agg(F.sum("n").alias("count")))
    # Empty bins: add a zero row for every bin, then sum (at most
    # 2 * len(columns) * bins rows).  Joining the counts to a grid instead
    # would make the optimizer repeat the bin rule as a join filter.
    zeros = ranges.select("column_name", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                          F.lit(0).cast("long").alias("count"))
    full = counts.unionByName(zeros).groupBy("column_name", "bin").agg(F.sum("count").alias("count"))
    return (full.join(F.broadcast(ranges), "column_name")
                .select("column_name", "bin",
                        _edge(F.col("bin"), F.col("lo"), F.col("hi"), bins).alias("bin_lo"),
                        _edge(F.col("bin") + 1, F.col("lo"), F.col("hi"), bins).alias("bin_hi"),
                        F.col("count").cast("long").alias("count"))
                .orderBy("column_name", "bin"))

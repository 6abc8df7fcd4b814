"""Exact quantiles as a pure DataFrame plan.

Semantics
---------
* ``disc``: the value of rank ``max(1, ceil(q * n))`` (1-based) among the
  non-null values.  This is the rank ``percentile_approx`` answers when its
  summary is exact, and what SQL engines call a discrete quantile.
* ``cont``: linear interpolation between ranks ``floor(h) + 1`` and
  ``floor(h) + 2`` with ``h = (n - 1) * q`` (the pandas / ``quantile_cont``
  definition).

Plan
----
1. unpivot the measured columns to ``(_col, _v)`` and pre-aggregate the rows (or
   the weights) per ``(keys, _col, _v)``.  Partial (map-side) aggregation
   collapses repeated values before the shuffle, so a group that holds a third
   of all rows shrinks to its distinct values.
2. the distinct values are counted into *cells*: ranges of nearly equal
   logarithm, in the order of the values.  A running sum over the cells of a
   group, which no group has many of, tells which cell holds each wanted rank.
3. only the values of those cells are ranked: a window per cell, over distinct
   values, not rows.  No task sorts a group, no range bounds are sampled and
   nothing is checkpointed: both uses of the distinct values read the same
   exchange.
4. one aggregate per ``keys`` picks the smallest value that reaches each rank.

Unlike ``percentile_approx`` the answer is exact at any scale, and unlike the
exact built-ins (``percentile``, ``median``) no per-group hash map of all
values has to fit in memory.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Quantile:
    """One requested quantile: output ``name`` of ``column`` at ``q``."""
    name: str
    column: str | Column
    q: float
    method: str = "disc"  # "disc" or "cont"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


CELLS = 4096  # cells between a value and e times that value


def _cell(v: Column, cells: int) -> Column:
    """An integer that never falls as ``v`` grows (-inf and numbers up to +inf,
    then NaN).  ``ln`` is semi-monotonic, so rounding cannot change the order."""
    size = F.floor((F.ln(F.abs(v)) + F.lit(750.0)) * F.lit(float(cells)))
    ends = F.lit(float(1 << 40))
    number = F.when(v == 0, F.lit(0.0)).when(v > 0, size.cast("double")).otherwise(-size.cast("double"))
    cell = F.when(F.isnan(v), ends * 2).when(v == F.lit(float("inf")), ends).when(v == F.lit(float("-inf")), -ends).otherwise(number)
    # never NULL, and said so: a NULL test on one use only would keep the two uses
    # of the counted values from sharing their exchange
    return F.coalesce(cell, F.lit(0.0))


def exact_quantiles(df: DataFrame, specs: Sequence[Quantile], by: Sequence[str] = (),
                    slices: int | None = None, weight: str | None = None) -> DataFrame:
    """Return one row per group of ``by`` (one row if empty) with a column
    per spec.  Groups with no non-null value get NULL or no row.

    ``slices`` (default ``CELLS``) is the number of cells between a value and e
    times that value; it changes the work, not the result.  ``weight`` names a
    column that says how many rows a row stands for.
    """
    by = list(by)
    # The same source expression measured at several q is ranked only once.
    sources: dict[str, Column] = {}
    source_of: dict[str, str] = {}
    for spec in specs:
        key = str(spec.column) if isinstance(spec.column, Column) else spec.column
        if key not in sources:
            sources[key] = _col(spec.column)
        source_of[spec.name] = f"s{list(sources).index(key)}"
    tags = {key: f"s{i}" for i, key in enumerate(sources)}

    # One struct key for the groups: NULL group values compare equal in it.
    group = F.struct(*[F.col(b) for b in by]) if by else F.lit(0)
    entries = F.array(*[
        F.struct(F.lit(tags[key]).alias("_col"), expr.cast("double").alias("_v"))
        for key, expr in sources.items()
    ])
    rows = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    long = (df.select(group.alias("_g"), rows.alias("_w"), F.explode(entries).alias("_e"))
              .select("_g", "_w", "_e._col", "_e._v")
              .where(F.col("_v").isNotNull()))
    counts = (long.groupBy("_g", "_col", "_v").agg(F.sum("_w").alias("_c"))
                  .withColumn("_cell", _cell(F.col("_v"), slices or CELLS)))

    # The ranks that are wanted.
    n = F.col("_n").cast("double")
    wanted: list[tuple[str, str, Column]] = []  # (key, tag, rank)
    for spec in specs:
        q = F.lit(float(spec.q))
        if spec.method == "disc":
            wanted.append((f"{spec.name}:d", source_of[spec.name], F.greatest(F.lit(1).cast("long"), F.ceil(q * n))))
        elif spec.method == "cont":
            low = F.floor((n - F.lit(1.0)) * q) + 1
            wanted.append((f"{spec.name}:l", source_of[spec.name], low))
            wanted.append((f"{spec.name}:h", source_of[spec.name], F.least(low + 1, F.col("_n"))))
        else:
            raise ValueError(f"unknown quantile method {spec.method!r}")

    # The cells that hold them, and the ranks inside the cell.
    grp = Window.partitionBy("_g", "_col")
    cells = counts.groupBy("_g", "_col", "_cell").agg(F.sum("_c").alias("_cc")).select(
        "_g", "_col", "_cell", "_cc", F.sum("_cc").over(grp).alias("_n"),
        (F.sum("_cc").over(grp.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_cc")).alias("_before"))

    def inside(tag: str, rank: Column) -> Column:
        at = rank.cast("long") - F.col("_before")
        return F.when((F.col("_col") == tag) & (at > 0) & (at <= F.col("_cc")), at)

    cells = cells.select("_g", "_col", "_cell", "_n", F.struct(
        *[inside(tag, rank).alias(f"r{i}") for i, (_, tag, rank) in enumerate(wanted)]).alias("_r"))
    cells = cells.where(F.coalesce(*[F.col(f"_r.r{i}") for i in range(len(wanted))]).isNotNull())

    order = Window.partitionBy("_g", "_col", "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(cells, ["_g", "_col", "_cell"]).withColumn("_cum", F.sum("_c").over(order))
    place = {key: i for i, (key, _, _) in enumerate(wanted)}

    def value(key: str) -> Column:
        return F.min(F.when(F.col("_cum") >= F.col(f"_r.r{place[key]}"), F.col("_v")))

    aggs = []
    for spec in specs:
        if spec.method == "disc":
            aggs.append(value(f"{spec.name}:d").alias(spec.name))
        else:
            h = (n - F.lit(1.0)) * F.lit(float(spec.q))
            part = F.max(F.when(F.col("_col") == source_of[spec.name], h - F.floor(h)))
            low, high = value(f"{spec.name}:l"), value(f"{spec.name}:h")
            aggs.append((low + (high - low) * part).alias(spec.name))

    out = ranked.groupBy("_g").agg(*aggs)
    if by:
        return out.select(*[F.col(f"_g.{b}").alias(b) for b in by], *[s.name for s in specs])
    # a global request always answers with one row, even on empty input
    return ranked.agg(*aggs)


def approx_quantiles(df: DataFrame, specs: Sequence[Quantile], by: Sequence[str] = (),
                     accuracy: int = 10000) -> DataFrame:
    """The sketch-based alternative (``percentile_approx``): one pass, memory
    O(accuracy) per group, rank error up to n / accuracy."""
    aggs = [F.percentile_approx(_col(s.column).cast("double"), s.q, accuracy).alias(s.name)
            for s in specs]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def quantiles(df: DataFrame, specs: Sequence[Quantile], by: Sequence[str] = (),
              accuracy: int | None = None) -> DataFrame:
    """Exact quantiles by default; ``accuracy`` switches to the sketch."""
    if accuracy is not None:
        if accuracy < 1:
            raise ValueError("accuracy must be at least 1 (leave it out for exact quantiles)")
        return approx_quantiles(df, specs, by, accuracy)
    return exact_quantiles(df, specs, by)

"""Numeric aggregates that give the same answer in every engine and run.

``ROUND(AVG(double), 2)`` depends on summation order: two engines (or two
runs with different partitioning) can land on opposite sides of a rounding
tie.  Sums of DECIMALs are exact and order-independent, so means and totals
are summed as ``DECIMAL(28,12)`` and rounded HALF_UP once.  No value is left
out and none is cut to cents: a group that holds NaN, an infinity or a value
beyond ``EXACT_LIMIT`` (which a DECIMAL cannot hold) gets what the plain
``AVG`` / ``SUM`` of its doubles gives, NaN included.

``CORR`` raises DIVIDE_BY_ZERO under ANSI mode for a group whose values do
not vary, so it is ``covar_pop / nullif(stddev_pop * stddev_pop, 0)`` behind an
exact ``min = max`` test: NULL for such groups.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,12)"
EXACT_LIMIT = 1e15


def _fits(x: Column) -> Column:
    """NaN compares greater than every number, so it does not fit."""
    return (x >= F.lit(-EXACT_LIMIT)) & (x <= F.lit(EXACT_LIMIT))


def _exact_sum(x: Column) -> Column:
    return F.sum(F.when(_fits(x), x).cast(EXACT))


def _all_fit(x: Column) -> Column:
    return F.count_if(~_fits(x)) == 0


def exact_mean_key(x: Column) -> Column:
    """Exact mean as DECIMAL (12 decimals), NULL where it is not exact: an
    ordering key beside :func:`exact_mean`."""
    return F.when(_all_fit(x), _exact_sum(x) / F.count(x))


def exact_mean(x: Column, scale: int | None = None) -> Column:
    """Mean as DOUBLE, rounded HALF_UP to ``scale`` decimals if given."""
    key, plain = exact_mean_key(x), F.avg(x)
    if scale is not None:
        key, plain = F.round(key, scale), F.round(plain, scale)
    return F.when(_all_fit(x), key.cast("double")).otherwise(plain)


def exact_total(x: Column, scale: int = 2) -> Column:
    """Sum as DOUBLE, rounded HALF_UP."""
    return F.when(_all_fit(x), F.round(_exact_sum(x), scale).cast("double")).otherwise(F.round(F.sum(x), scale))


def exact_mean_pct(x: Column, scale: int = 2) -> Column:
    """``100 * mean(x)`` as DOUBLE, rounded HALF_UP."""
    return F.when(_all_fit(x), F.round(exact_mean_key(x) * 100, scale).cast("double")).otherwise(F.round(F.avg(x) * 100, scale))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL (not an error) when either side is constant.

    Constancy is tested exactly with MIN = MAX: merged partial moments of
    identical values can leave a tiny non-zero variance (depending on how
    the rows were split over tasks), which would turn into a meaningless
    correlation instead of NULL."""
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y))
    spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
    return F.when(constant, F.lit(None).cast("double")).otherwise(F.covar_pop(x, y) / spread)


def pct_of(n: Column, total: Column, scale: int = 2) -> Column:
    """``round(100 * n / total, scale)`` with exact HALF_UP rounding, DOUBLE.

    Integer arithmetic only, so the result does not depend on how the
    engine divides.  NULL when ``total`` is 0.
    """
    k = 10 ** (scale + 2)
    num = (n.cast("long") * F.lit(2 * k) + total.cast("long")).cast("decimal(38,0)")
    den = F.nullif(total.cast("long") * F.lit(2), F.lit(0)).cast("decimal(38,0)")
    return (F.floor(num / den) / F.lit(10 ** scale)).cast("double")

"""Joins against lookup-sized frames.

A broadcast is only safe when the broadcast side has a proven size bound.
``lookup_join`` materialises the small side once, checks its row count
against a byte budget, and broadcasts only under the budget.  Beyond it the
join is a plain shuffle join, which AQE can still turn into a broadcast (or
split skewed partitions for) at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.session import staged_table

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_WIDTH = {"ByteType": 1, "BooleanType": 1, "ShortType": 2, "IntegerType": 4, "FloatType": 4,
          "DateType": 4, "LongType": 8, "DoubleType": 8, "TimestampType": 8,
          "TimestampNTZType": 8, "DecimalType": 16, "StringType": 20}


def _row_width(df: DataFrame) -> int:
    # The same per-value estimates Spark's planner uses (20 bytes per string).
    return 8 + sum(_WIDTH.get(type(f.dataType).__name__, 32) for f in df.schema.fields)


def bounded_rows(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> int:
    return max(1, max_bytes // _row_width(df))


def fits_broadcast(small: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``small`` has at most ``max_bytes`` worth of rows.

    Counts at most bound + 1 rows, so the check stops early on a big frame.
    """
    limit = bounded_rows(small, max_bytes)
    return small.limit(limit + 1).count() <= limit


def lookup_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
                max_bytes: int = DEFAULT_BROADCAST_BYTES, written: bool = False) -> DataFrame:
    """Join ``big`` to a lookup frame, broadcasting it only if it fits.

    The lookup is written once in the shared folder when the join is built (unless
    it is ``written`` already), and counted there: the check and the join read the
    same rows, and nothing stays persisted in executors."""
    if not written:
        small = staged_table(small, "lookup")
    keys = [on] if isinstance(on, str) else list(on)
    return big.join(F.broadcast(small) if fits_broadcast(small, max_bytes) else small, on=keys, how=how)

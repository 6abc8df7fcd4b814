"""Labels and buckets (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the pipeline's published labels).
# time of day by pickup hour: [5,12) morning, [12,17) afternoon,
#   [17,22) evening, anything else (including NULL) night
TIME_OF_DAY = (("morning", 5, 12), ("afternoon", 12, 17), ("evening", 17, 22))
TIME_OF_DAY_DEFAULT = "night"
# distance bucket by cleaned distance: < 2 short, < 7 medium, else long
DISTANCE_BUCKETS = (("short", 2), ("medium", 7))
DISTANCE_BUCKET_DEFAULT = "long"
TRIP_CATEGORY_DESC = (("short", "< 2 miles"), ("medium", "2 to < 7 miles"))
TRIP_CATEGORY_DEFAULT = ">= 7 miles"
# payment codes
PAYMENT_DESC = ((1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"),
                (5, "Unknown"), (6, "Voided"))
PAYMENT_DESC_DEFAULT = "Other"
# weekday abbreviations in calendar order (Q1 sort order)
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# ---------------------------------------------------------------------------


def time_of_day(hour: Column) -> Column:
    expr = None
    for label, lo, hi in TIME_OF_DAY:
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(TIME_OF_DAY_DEFAULT))


def distance_bucket(distance: Column) -> Column:
    expr = None
    for label, upper in DISTANCE_BUCKETS:
        cond = distance < upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(DISTANCE_BUCKET_DEFAULT))


def trip_category_desc(bucket: Column) -> Column:
    expr = None
    for label, desc in TRIP_CATEGORY_DESC:
        cond = bucket == label
        expr = F.when(cond, F.lit(desc)) if expr is None else expr.when(cond, F.lit(desc))
    return expr.otherwise(F.lit(TRIP_CATEGORY_DEFAULT))


def payment_desc(code: Column) -> Column:
    expr = None
    for value, desc in PAYMENT_DESC:
        cond = code == value
        expr = F.when(cond, F.lit(desc)) if expr is None else expr.when(cond, F.lit(desc))
    return expr.otherwise(F.lit(PAYMENT_DESC_DEFAULT))


def weekday_number(day: Column) -> Column:
    """1 for Monday to 7 for Sunday, 8 for anything else (calendar order)."""
    place = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), day)
    return F.when(place > 0, place).otherwise(len(WEEKDAYS) + 1)

"""Independent DuckDB SQL for every query with an exact answer.

Each string runs on DuckDB with the given tables registered as views.  The
whole pipeline (raw trips from ``lineitem``, cleaning, star schema, queries)
is re-stated as one chain of CTEs, written from the semantics, not from the
Spark plans.

Engine differences bridged here:

* Spark rounds a DOUBLE by its shortest decimal form, HALF_UP; DuckDB rounds
  the binary value.  ``_sround`` rounds the shortest form as a DECIMAL,
  which is Spark's rule.
* DuckDB divides DECIMALs in DOUBLE, so exact money means and percentages
  use integer arithmetic (``_half_up``).
* DuckDB returns BIGINT for calendar parts and ranks; they are cast to the
  INTEGER Spark returns.
"""

from __future__ import annotations

RAW = ("VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
       "fare_amount, tip_amount, payment_type, PULocationID, DOLocationID")


def _sround(expr: str, digits: int) -> str:
    return (f"(CASE WHEN isnan({expr}) OR isinf({expr}) THEN {expr} ELSE "
            f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,12)), {digits}) AS DOUBLE) END)")


def _half_up(num: str, den: str) -> str:
    """round_half_up(num / den) for integers, sign-aware; NULL if den = 0."""
    return (f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * "
            f"((2 * abs(CAST({num} AS HUGEINT)) + ({den})) // NULLIF(2 * CAST({den} AS HUGEINT), 0)))")


def _money_avg(col: str) -> str:
    cents = f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    return f"(CAST({_half_up(cents, f'COUNT({col})')} AS DOUBLE) / 100)"


def _money_total(col: str) -> str:
    return f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) AS DOUBLE)"


def _money_mean_key(col: str) -> str:
    """The exact mean at 12 decimals (Spark's DECIMAL(38,12) mean), as an integer."""
    cents = f"CAST(SUM(CAST({col} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    return _half_up(f"{cents} * CAST(10000000000 AS HUGEINT)", f"COUNT({col})")


def _pct(n: str, total: str, digits: int) -> str:
    k = 10 ** (digits + 2)
    return f"(CAST({_half_up(f'({n}) * {k}', total)} AS DOUBLE) / {10 ** digits})"


# Fixed values, written out here a second time on purpose: a wrong bound or
# label in the production tables must not be wrong on this side too.
_TIME_OF_DAY = ("CASE WHEN pickup_hour >= 5 AND pickup_hour < 12 THEN 'morning' "
                "WHEN pickup_hour >= 12 AND pickup_hour < 17 THEN 'afternoon' "
                "WHEN pickup_hour >= 17 AND pickup_hour < 22 THEN 'evening' ELSE 'night' END")
_BUCKET = ("CASE WHEN trip_distance_clean < 2 THEN 'short' WHEN trip_distance_clean < 7 THEN 'medium' "
           "ELSE 'long' END")
_PAYMENT = ("CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' "
            "WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided' ELSE 'Other' END")
_CATEGORY = ("CASE distance_bucket WHEN 'short' THEN '< 2 miles' WHEN 'medium' THEN '2 to < 7 miles' "
             "ELSE '>= 7 miles' END")
_WEEKDAY = ("CASE pickup_weekday WHEN 'Mon' THEN 1 WHEN 'Tue' THEN 2 WHEN 'Wed' THEN 3 WHEN 'Thu' THEN 4 "
            "WHEN 'Fri' THEN 5 WHEN 'Sat' THEN 6 WHEN 'Sun' THEN 7 ELSE 8 END")

_TS = "TIMESTAMP '2024-01-01 00:00:00'"

RAW_TRIPS = f"""
raw_trips AS (
  WITH k AS (
    SELECT *, (l_orderkey*37 + l_linenumber*101) % 44640 AS pu_min,
           CASE WHEN l_partkey % 97 = 0 THEN -5 ELSE 1 + l_partkey % 90 END AS dur_min,
           300 + (l_orderkey*l_linenumber) % 9000 AS fare_cents
    FROM lineitem),
  t AS (
    SELECT l_orderkey,
      CAST(CASE WHEN l_suppkey % 10 = 0 THEN NULL WHEN l_suppkey % 10 < 4 THEN 1 WHEN l_suppkey % 10 < 9 THEN 2 ELSE 6 END AS INT) AS VendorID,
      CASE WHEN l_orderkey % 199 = 0 THEN NULL ELSE {_TS} + to_minutes(CAST(pu_min AS INTEGER)) END AS tpep_pickup_datetime,
      {_TS} + to_minutes(CAST(pu_min + dur_min AS INTEGER)) AS tpep_dropoff_datetime,
      CASE l_orderkey % 20 WHEN 0 THEN NULL WHEN 1 THEN 0e0 WHEN 2 THEN 1.5e0 WHEN 3 THEN 2.5e0 ELSE CAST(1 + l_linenumber % 5 AS DOUBLE) END AS passenger_count,
      CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 211 = 0 THEN 500e0 ELSE CAST((l_partkey*13 + l_linenumber*7) % 2400 AS DOUBLE) / 100e0 END AS trip_distance,
      CASE WHEN l_partkey % 211 = 0 THEN CAST(-fare_cents AS DOUBLE) / 100e0 WHEN l_orderkey % 41 = 0 THEN NULL WHEN l_orderkey % 37 = 0 THEN 0e0
           WHEN l_orderkey % 31 = 0 THEN CAST(-fare_cents AS DOUBLE) / 100e0 ELSE CAST(fare_cents AS DOUBLE) / 100e0 END AS fare_amount,
      CASE WHEN l_orderkey % 43 = 0 THEN NULL WHEN l_orderkey % 8 < 5 THEN CAST((l_partkey*l_linenumber) % 1200 AS DOUBLE) / 100e0 ELSE 0e0 END AS tip_amount,
      CAST(CASE l_orderkey % 8 WHEN 5 THEN 2 WHEN 6 THEN 3 + l_linenumber % 3 WHEN 7 THEN NULL ELSE 1 END AS BIGINT) AS payment_type,
      CAST(1 + l_suppkey % 4 AS INT) AS PULocationID,
      CAST(CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE 1 + l_partkey % 5 END AS INT) AS DOLocationID
    FROM k)
  SELECT {RAW} FROM t
  UNION ALL
  SELECT {RAW} FROM t WHERE l_orderkey % 100 = 0)"""

CLEAN_CHAIN = f"""{RAW_TRIPS},
dedup AS (SELECT DISTINCT * FROM raw_trips),
prep AS (
  SELECT *,
    CAST(tpep_pickup_datetime AS TIMESTAMP) AS pickup_ts,
    CAST(tpep_dropoff_datetime AS TIMESTAMP) AS dropoff_ts,
    (floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60.0 AS trip_duration_minutes,
    {_sround('trip_distance * 2', 0)} / 2 AS distance_bin
  FROM dedup),
bin_med AS (
  SELECT distance_bin, quantile_disc(fare_amount, 0.5) AS fare_med FROM prep GROUP BY distance_bin),
s_fare AS (
  SELECT p.*, CASE WHEN p.fare_amount < 0 THEN m.fare_med ELSE p.fare_amount END AS fare_amount_clean
  FROM prep p LEFT JOIN bin_med m ON p.distance_bin = m.distance_bin),
s_pass AS (
  SELECT *, greatest(1, CAST({_sround('passenger_count', 0)} AS INTEGER)) AS passenger_count_clean FROM s_fare),
s_tip AS (
  SELECT *, CAST(CASE WHEN tip_amount > fare_amount_clean THEN fare_amount_clean ELSE tip_amount END AS DOUBLE)
    AS tip_amount_clean FROM s_pass),
p99 AS (SELECT quantile_disc(trip_distance, 0.99) AS p99_distance FROM s_tip),
s_cap AS (
  SELECT s.*, CASE WHEN s.trip_distance > p.p99_distance THEN p.p99_distance ELSE s.trip_distance END
    AS trip_distance_clean
  FROM s_tip s CROSS JOIN p99 p),
meds AS (
  SELECT quantile_disc(trip_distance_clean, 0.5) AS median_distance,
         quantile_disc(fare_amount_clean, 0.5) AS median_fare,
         quantile_disc(tip_amount_clean, 0.5) AS median_tip,
         quantile_disc(trip_duration_minutes, 0.5) AS median_duration
  FROM s_cap),
s_imp AS (
  SELECT s.* REPLACE (
      coalesce(s.trip_distance_clean, m.median_distance) AS trip_distance_clean,
      coalesce(s.fare_amount_clean, m.median_fare) AS fare_amount_clean,
      coalesce(s.tip_amount_clean, m.median_tip) AS tip_amount_clean,
      coalesce(s.trip_duration_minutes, m.median_duration) AS trip_duration_minutes)
  FROM s_cap s CROSS JOIN meds m),
s_def AS (
  SELECT * REPLACE (
      coalesce(payment_type, 0) AS payment_type,
      coalesce(VendorID, 0) AS VendorID,
      CAST(coalesce(PULocationID, 0) AS INTEGER) AS PULocationID,
      CAST(coalesce(DOLocationID, 0) AS INTEGER) AS DOLocationID)
  FROM s_imp),
s_cal AS (
  SELECT *,
    CAST(pickup_ts AS DATE) AS pickup_date,
    CAST(year(pickup_ts) AS INTEGER) AS pickup_year,
    CAST(month(pickup_ts) AS INTEGER) AS pickup_month,
    CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour,
    strftime(pickup_ts, '%a') AS pickup_weekday
  FROM s_def),
clean AS (
  SELECT *, {_TIME_OF_DAY} AS time_of_day,
         fare_amount_clean + tip_amount_clean AS total_revenue,
         {_BUCKET} AS distance_bucket
  FROM s_cal)"""

STAR = f"""
dim_datetime AS (
  SELECT CAST(row_number() OVER (ORDER BY pickup_date, pickup_hour) AS INTEGER) AS datetime_key, *
  FROM (SELECT DISTINCT pickup_date, pickup_year, pickup_month, pickup_hour, pickup_weekday, time_of_day
        FROM clean WHERE pickup_date IS NOT NULL)),
dim_payment AS (
  SELECT payment_type, {_PAYMENT} AS payment_desc
  FROM (SELECT DISTINCT payment_type FROM clean)),
dim_trip_category AS (
  SELECT distance_bucket, {_CATEGORY} AS trip_category_desc
  FROM (SELECT DISTINCT distance_bucket FROM clean)),
fact_trips AS (
  SELECT d.datetime_key, c.payment_type, c.distance_bucket, c.VendorID, c.PULocationID, c.DOLocationID,
         c.passenger_count_clean, c.trip_distance_clean, c.trip_duration_minutes, c.fare_amount_clean,
         c.tip_amount_clean, c.total_revenue, c.pickup_year, c.pickup_month, c.pickup_date
  FROM clean c LEFT JOIN dim_datetime d
    ON c.pickup_date = d.pickup_date AND c.pickup_year = d.pickup_year AND c.pickup_month = d.pickup_month
   AND c.pickup_hour = d.pickup_hour AND c.pickup_weekday = d.pickup_weekday AND c.time_of_day = d.time_of_day)"""

_Q1 = f"""
q1 AS (
  SELECT d.pickup_weekday, d.pickup_hour, COUNT(*) AS trip_count, {_money_avg('f.fare_amount_clean')} AS avg_fare
  FROM fact_trips f JOIN dim_datetime d ON f.datetime_key = d.datetime_key
  GROUP BY d.pickup_weekday, d.pickup_hour)"""

_Q2 = f"""
q2 AS (
  SELECT {_sround('f.trip_distance_clean', 1)} AS distance_bin, COUNT(*) AS trip_count,
         {_money_avg('f.fare_amount_clean')} AS avg_fare,
         CASE WHEN min(f.trip_distance_clean) = max(f.trip_distance_clean)
                OR min(f.fare_amount_clean) = max(f.fare_amount_clean) THEN NULL
              ELSE {_sround('covar_pop(f.trip_distance_clean, f.fare_amount_clean) / NULLIF(stddev_pop(f.trip_distance_clean) * stddev_pop(f.fare_amount_clean), 0)', 4)}
         END AS distance_fare_corr
  FROM fact_trips f
  GROUP BY 1
  HAVING COUNT(*) >= 50)"""

_Q3 = f"""
q3_groups AS (
  SELECT f.PULocationID, d.pickup_hour, p.payment_desc, COUNT(*) AS trip_count
  FROM fact_trips f JOIN dim_datetime d ON f.datetime_key = d.datetime_key
  JOIN dim_payment p ON f.payment_type = p.payment_type
  GROUP BY f.PULocationID, d.pickup_hour, p.payment_desc
  HAVING COUNT(*) >= 100),
q3 AS (
  SELECT PULocationID, pickup_hour, payment_desc, trip_count,
         {_pct('trip_count', 'SUM(trip_count) OVER (PARTITION BY PULocationID, pickup_hour)', 2)} AS payment_share_pct
  FROM q3_groups
  ORDER BY trip_count DESC, PULocationID, pickup_hour, payment_desc
  LIMIT 200)"""

_Q4 = f"""
q4 AS (
  SELECT p.payment_desc, f.distance_bucket, f.VendorID, COUNT(*) AS trip_count,
         {_money_avg('f.tip_amount_clean')} AS avg_tip,
         {_sround('AVG(f.tip_amount_clean / NULLIF(f.fare_amount_clean, 0)) * 100', 2)} AS avg_tip_pct_of_fare
  FROM fact_trips f JOIN dim_payment p ON f.payment_type = p.payment_type
  GROUP BY p.payment_desc, f.distance_bucket, f.VendorID
  HAVING COUNT(*) >= 100)"""

_Q5 = f"""
q5_pairs AS (
  SELECT PULocationID, DOLocationID, COUNT(*) AS trip_count,
         {_money_mean_key('fare_amount_clean')} AS mean_key,
         {_money_avg('fare_amount_clean')} AS avg_fare,
         {_money_total('total_revenue')} AS total_revenue
  FROM fact_trips GROUP BY PULocationID, DOLocationID HAVING COUNT(*) >= 50),
q5 AS (
  SELECT PULocationID, DOLocationID, trip_count, avg_fare, total_revenue,
         CAST(dense_rank() OVER (ORDER BY trip_count DESC, mean_key DESC) AS INTEGER) AS pair_rank
  FROM q5_pairs
  ORDER BY trip_count DESC, mean_key DESC, PULocationID, DOLocationID
  LIMIT 100)"""

QUERY_CTES = ",".join([_Q1, _Q2, _Q3, _Q4, _Q5])


def _with(select: str, star: bool = True, queries: bool = False) -> str:
    parts = [CLEAN_CHAIN]
    if star:
        parts.append(STAR)
    if queries:
        parts.append(QUERY_CTES)
    return "WITH " + ",".join(parts) + "\n" + select


def _raw_with(select: str) -> str:
    return "WITH " + RAW_TRIPS + "\n" + select


_PROFILE = (f"{RAW_TRIPS},\nprofile AS (SELECT *, (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime))"
            " / 60000000.0 AS trip_duration_minutes FROM raw_trips)")
_PROFILE_COLUMNS = [("VendorID", "int"), ("tpep_pickup_datetime", "timestamp_ntz"),
                    ("tpep_dropoff_datetime", "timestamp_ntz"), ("passenger_count", "double"),
                    ("trip_distance", "double"), ("fare_amount", "double"), ("tip_amount", "double"),
                    ("payment_type", "bigint"), ("PULocationID", "int"), ("DOLocationID", "int"),
                    ("trip_duration_minutes", "double")]
_NUMERIC = [c for c, t in _PROFILE_COLUMNS if t in ("int", "double", "bigint")]
_HIST = ["trip_distance", "fare_amount", "passenger_count", "tip_amount", "trip_duration_minutes"]
_ISSUE_DECIMALS = {"Duplicate rows": 2, "Negative fare amount": 4, "Zero passenger count": 2,
                   "Passenger count non-integer": 2, "Trip distance outliers (IQR)": 2,
                   "Future pickup timestamps": 4, "Tip greater than fare": 4}
_ISSUE_POS = {k: i for i, k in enumerate(_ISSUE_DECIMALS, start=1)}
FUTURE_AS_OF = "2024-01-25 00:00:00"


def _issue(name: str, n: str, total: str) -> str:
    d = _ISSUE_DECIMALS[name]
    pct = _pct(n, total, d)
    return (f"SELECT {_ISSUE_POS[name]} AS position, '{name}' AS issue, CAST({n} AS BIGINT) AS n, {pct} AS pct, "
            f"CAST({n} AS VARCHAR) || ' (' || CAST(CAST({pct} AS DECIMAL(38,{d})) AS VARCHAR) || '%)' AS display")


def _edge(i: str, lo: str = "lo", hi: str = "hi") -> str:
    return f"(CASE WHEN {i} = 50 THEN {hi} ELSE CAST({i} AS DOUBLE) * (({hi} - {lo}) / 50.0) + {lo} END)"


def _hist_sql() -> str:
    parts = []
    for c in _HIST:
        parts.append(f"""
    SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x,
           CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
    FROM profile, (SELECT min(CAST({c} AS DOUBLE)) AS lo, max(CAST({c} AS DOUBLE)) AS hi FROM profile) r""")
    vals = " UNION ALL ".join(parts)
    return f"""WITH {_PROFILE},
vals AS ({vals}),
g AS (SELECT column_name, x, lo, hi,
             LEAST(CAST(trunc(((x - lo) / (hi - lo)) * 50.0) AS INTEGER), 49) AS g0 FROM vals WHERE x IS NOT NULL),
d AS (SELECT *, CASE WHEN x < {_edge('g0')} THEN g0 - 1 ELSE g0 END AS g1 FROM g),
b AS (SELECT column_name, CASE WHEN x >= {_edge('(g1 + 1)')} AND g1 <> 49 THEN g1 + 1 ELSE g1 END AS bin FROM d),
counts AS (SELECT column_name, bin, COUNT(*) AS cnt FROM b GROUP BY 1, 2),
ranges AS (SELECT DISTINCT column_name, lo, hi FROM vals WHERE lo IS NOT NULL),
grid AS (SELECT column_name, lo, hi, CAST(i AS INTEGER) AS bin FROM ranges, range(0, 50) t(i))
SELECT g.column_name, g.bin, {_edge('g.bin', 'g.lo', 'g.hi')} AS bin_lo,
       {_edge('(g.bin + 1)', 'g.lo', 'g.hi')} AS bin_hi,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM grid g LEFT JOIN counts c ON g.column_name = c.column_name AND g.bin = c.bin"""


def _schema_sql() -> str:
    rows = []
    for i, (c, t) in enumerate(_PROFILE_COLUMNS, start=1):
        rows.append(f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
                    f"coalesce(substring(CAST(min({c}) AS VARCHAR), 1, 50), 'NaN') AS sample_value FROM profile")
    return f"WITH {_PROFILE}\n" + " UNION ALL ".join(rows)


def _missing_sql() -> str:
    rows = []
    for i, (c, t) in enumerate(_PROFILE_COLUMNS, start=1):
        miss = f"({c} IS NULL OR isnan({c}))" if t == "double" else f"{c} IS NULL"
        n = f"CAST(count_if({miss}) AS BIGINT)"
        rows.append(f"SELECT {i} AS position, '{c}' AS column_name, {n} AS missing_count, "
                    f"{_pct(n, 'COUNT(*)', 2)} AS missing_pct FROM profile")
    return f"WITH {_PROFILE}\n" + " UNION ALL ".join(rows)


def _stats_sql(source: str = _PROFILE) -> str:
    rows = []
    for i, c in enumerate(_NUMERIC, start=1):
        x = f"CAST({c} AS DOUBLE)"
        rows.append(f"SELECT {i} AS position, '{c}' AS column_name, {_sround(f'avg({x})', 2)} AS mean, "
                    f"{_sround(f'quantile_cont({x}, 0.5)', 2)} AS median, {_sround(f'stddev_samp({x})', 2)} AS std, "
                    f"{_sround(f'min({x})', 2)} AS min, {_sround(f'max({x})', 2)} AS max FROM profile")
    return f"WITH {source}\n" + " UNION ALL ".join(rows)


# Dirty rows: NaN is missing in every report, an unreadable time is no time.
_DIRTY = RAW_TRIPS.replace("raw_trips AS (", "clean_raw AS (", 1) + """,
raw_trips AS (
  SELECT VendorID, CASE WHEN passenger_count = 1.5 THEN NULL ELSE tpep_pickup_datetime END AS tpep_pickup_datetime,
         tpep_dropoff_datetime, CASE WHEN passenger_count = 2.5 THEN NULL ELSE passenger_count END AS passenger_count,
         CASE WHEN trip_distance = 500 THEN NULL ELSE trip_distance END AS trip_distance, fare_amount,
         CASE WHEN tip_amount = 0 THEN NULL ELSE tip_amount END AS tip_amount, payment_type, PULocationID, DOLocationID
  FROM clean_raw)"""
_DIRTY_PROFILE = (_DIRTY + ",\nprofile AS (SELECT *, (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime))"
                  " / 60000000.0 AS trip_duration_minutes FROM raw_trips)")
_TWO_LOADS = f"""
, files AS (
  SELECT DISTINCT CAST(CASE WHEN PULocationID <= 2 THEN 202401 ELSE 202402 END AS INTEGER) AS load_month,
         {RAW.replace("tpep_pickup_datetime", "tpep_pickup_datetime + to_days(CASE WHEN PULocationID <= 2 THEN 0 ELSE 20 END) AS pickup")
             .replace("tpep_dropoff_datetime", "tpep_dropoff_datetime + to_days(CASE WHEN PULocationID <= 2 THEN 0 ELSE 20 END) AS dropoff")}
  FROM raw_trips),
trips AS (
  SELECT load_month, CAST(year(pickup) AS INTEGER) AS pickup_year, CAST(month(pickup) AS INTEGER) AS pickup_month,
         COUNT(*) AS trips, CAST(COUNT(pickup) AS BIGINT) AS keyed_trips,
         CAST(SUM(greatest(1, CAST({_sround('passenger_count', 0)} AS INTEGER))) AS BIGINT) AS passengers
  FROM files GROUP BY 1, 2, 3)
SELECT l.loads, t.* FROM trips t, (VALUES ('reload'), ('reverse')) l(loads)""".replace("\n, files", ", files", 1)


_DQ_SIMPLE = [
    ("Negative fare amount", "count_if(fare_amount < 0)"),
    ("Zero passenger count", "count_if(passenger_count = 0)"),
    ("Passenger count non-integer",
     "count_if(passenger_count IS NULL OR isnan(passenger_count) OR isinf(passenger_count) "
     "OR passenger_count <> round(passenger_count))"),
    ("Tip greater than fare", "count_if(tip_amount > fare_amount)"),
]
_DQ_DUP = f"""SELECT * FROM (WITH g AS (SELECT COUNT(*) AS c FROM raw_trips GROUP BY ALL_COLUMNS)
  {_issue('Duplicate rows', 'SUM(c - 1)', 'SUM(c)')} FROM g)""".replace(
    "ALL_COLUMNS", RAW)
_DQ_IQR = f"""SELECT * FROM (WITH q AS (SELECT quantile_cont(trip_distance, 0.25) AS q1, quantile_cont(trip_distance, 0.75) AS q3 FROM raw_trips)
  {_issue('Trip distance outliers (IQR)', 'count_if(trip_distance < q1 - 1.5 * (q3 - q1) OR trip_distance > q3 + 1.5 * (q3 - q1))', 'COUNT(*)')}
  FROM raw_trips, q)"""
_DQ_FUTURE = f"""SELECT * FROM ({_issue('Future pickup timestamps', f"count_if(tpep_pickup_datetime > TIMESTAMP '{FUTURE_AS_OF}')", 'COUNT(*)')}
  FROM raw_trips)"""
_DQ_SIMPLE_SQL = " UNION ALL ".join(f"SELECT * FROM ({_issue(name, n, 'COUNT(*)')} FROM raw_trips)"
                                    for name, n in _DQ_SIMPLE)


_FFILL_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in [
    "tpep_dropoff_datetime", "tpep_pickup_datetime", "passenger_count", "trip_distance", "fare_amount",
    "tip_amount", "payment_type", "PULocationID", "DOLocationID"])


def _modes() -> str:
    parts = []
    for c in ("VendorID", "payment_type", "PULocationID", "DOLocationID"):
        parts.append(f"mode_{c} AS (SELECT {c} AS v FROM d WHERE {c} IS NOT NULL GROUP BY {c} "
                     f"ORDER BY COUNT(*) DESC, {c} LIMIT 1)")
    return ",\n".join(parts)


def _clean_select(cols: str, source: str) -> str:
    return _with(f"SELECT {cols} FROM {source}", star=False)


CLEAN_OUTPUT = (RAW + ", trip_duration_minutes, distance_bin, fare_amount_clean, passenger_count_clean, "
                "tip_amount_clean, trip_distance_clean, pickup_date, pickup_year, pickup_month, pickup_hour, "
                "pickup_weekday, time_of_day, total_revenue, distance_bucket")
FACT_OUTPUT = ("datetime_key, payment_type, distance_bucket, VendorID, PULocationID, DOLocationID, "
               "passenger_count_clean, trip_distance_clean, trip_duration_minutes, fare_amount_clean, "
               "tip_amount_clean, total_revenue, pickup_year, pickup_month, pickup_date")


def oracle_sql() -> dict[str, str]:
    top4 = ("SELECT pickup_weekday FROM q1 GROUP BY pickup_weekday "
            "ORDER BY SUM(trip_count) DESC, pickup_weekday LIMIT 4")
    validate = " UNION ALL ".join([
        "SELECT 'dim_datetime' AS table_name, COUNT(*) AS row_count, 'datetime_key' AS key_column, CAST(count_if(datetime_key IS NULL) AS BIGINT) AS null_count FROM dim_datetime",
        "SELECT 'dim_datetime', COUNT(*), 'pickup_date', count_if(pickup_date IS NULL) FROM dim_datetime",
        "SELECT 'dim_payment', COUNT(*), 'payment_type', count_if(payment_type IS NULL) FROM dim_payment",
        "SELECT 'dim_trip_category', COUNT(*), 'distance_bucket', count_if(distance_bucket IS NULL) FROM dim_trip_category",
        "SELECT 'fact_trips', COUNT(*), 'datetime_key', count_if(datetime_key IS NULL) FROM fact_trips",
        "SELECT 'fact_trips', COUNT(*), 'payment_type', count_if(payment_type IS NULL) FROM fact_trips",
        "SELECT 'fact_trips', COUNT(*), 'distance_bucket', count_if(distance_bucket IS NULL) FROM fact_trips",
        "SELECT 'raw', COUNT(*), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT) FROM raw_trips",
    ])
    dtypes = ("VendorID:int, tpep_pickup_datetime:timestamp_ntz, tpep_dropoff_datetime:timestamp_ntz, "
              "passenger_count:double, trip_distance:double")
    return {
        # sources / landing
        "scan_raw": _raw_with(f"SELECT {RAW} FROM raw_trips"),
        "land_raw": _raw_with(f"SELECT {RAW}, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month FROM raw_trips"),
        "gate_raw": _raw_with(
            "SELECT 'row_count' AS \"check\", COUNT(*) AS observed, CAST(500000 AS BIGINT) AS threshold, "
            "CASE WHEN COUNT(*) >= 500000 THEN 'pass' ELSE 'warn' END AS severity, 'rows in the raw data' AS detail "
            "FROM raw_trips UNION ALL "
            f"SELECT 'column_count', CAST(10 AS BIGINT), CAST(8 AS BIGINT), 'pass', '{dtypes}'"),
        "landing_check": ("SELECT * FROM (VALUES ('exists', CAST(1 AS BIGINT), 'pass'), ('empty_files', 0, 'pass'), "
                          "('non_parquet_files', 0, 'pass'), ('readable', 1, 'pass')) t(\"check\", threshold, severity) "
                          "UNION ALL " + "SELECT * FROM (" + _raw_with("SELECT 'rows_landed', COUNT(*), 'pass' FROM raw_trips") + ")"),
        # a sample of 10,000 rows: all of it comes from the raw rows
        "sample_n": _raw_with("SELECT CAST(least(10000, COUNT(*)) AS BIGINT) AS sampled_rows, "
                              "CAST(0 AS BIGINT) AS rows_not_in_source FROM raw_trips"),
        "two_loads": _raw_with(_TWO_LOADS),
        "profile_dirty": _stats_sql(_DIRTY_PROFILE),
        "dq_dirty": f"WITH {_DIRTY}\n" + " UNION ALL ".join([_DQ_DUP, _DQ_SIMPLE_SQL, _DQ_IQR, _DQ_FUTURE]),
        # profile
        "profile_duration": f"WITH {_PROFILE}\nSELECT * FROM profile",
        "schema_report": _schema_sql(),
        "profile_missing": _missing_sql(),
        "profile_stats": _stats_sql(),
        "profile_histogram": _hist_sql(),
        "dq_duplicates": _raw_with(_DQ_DUP),
        "dq_issues": _raw_with(_DQ_SIMPLE_SQL),
        "dq_iqr": _raw_with(_DQ_IQR),
        "dq_future": _raw_with(_DQ_FUTURE),
        "dq_report": _raw_with(" UNION ALL ".join([_DQ_DUP, _DQ_SIMPLE_SQL, _DQ_IQR, _DQ_FUTURE])),
        # cleaning steps
        "clean_dedupe": _raw_with(f"SELECT DISTINCT {RAW} FROM raw_trips"),
        "clean_duration": _clean_select(f"{RAW}, trip_duration_minutes", "prep"),
        "fare_medians": _clean_select("distance_bin, fare_med", "bin_med"),
        "clean_fare": _clean_select(f"{RAW}, distance_bin, fare_amount_clean", "s_fare"),
        "clean_passengers": _clean_select(f"{RAW}, passenger_count_clean", "s_pass"),
        "clean_tip": _clean_select(f"{RAW}, fare_amount_clean, tip_amount_clean", "s_tip"),
        "global_stats": _clean_select(
            "p99_distance, median_distance, median_fare, median_tip, median_duration", "p99 CROSS JOIN meds"),
        "clean_distance": _clean_select(f"{RAW}, trip_distance_clean", "s_cap"),
        "clean_impute": _clean_select(
            f"{RAW}, trip_distance_clean, fare_amount_clean, tip_amount_clean, trip_duration_minutes", "s_imp"),
        "clean_defaults": _raw_with(
            "SELECT CAST(coalesce(VendorID, 0) AS INT) AS VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, "
            "passenger_count, trip_distance, fare_amount, tip_amount, coalesce(payment_type, 0) AS payment_type, "
            "CAST(coalesce(PULocationID, 0) AS INTEGER) AS PULocationID, CAST(coalesce(DOLocationID, 0) AS INTEGER) AS DOLocationID "
            "FROM (SELECT DISTINCT * FROM raw_trips)"),
        "derive_calendar": _clean_select(
            f"{RAW}, CAST(pickup_ts AS DATE) AS pickup_date, CAST(year(pickup_ts) AS INTEGER) AS pickup_year, "
            "CAST(month(pickup_ts) AS INTEGER) AS pickup_month, CAST(hour(pickup_ts) AS INTEGER) AS pickup_hour, "
            "strftime(pickup_ts, '%a') AS pickup_weekday", "prep"),
        "derive_buckets": _clean_select(f"{RAW}, time_of_day, total_revenue, distance_bucket", "clean"),
        "clean_trips": _clean_select(CLEAN_OUTPUT, "clean"),
        # star schema
        "dim_datetime": _with("SELECT * FROM dim_datetime"),
        "dim_payment": _with("SELECT * FROM dim_payment"),
        "dim_trip_category": _with("SELECT * FROM dim_trip_category"),
        "fact_trips": _with(f"SELECT {FACT_OUTPUT} FROM fact_trips"),
        "validate_star": _with(validate),
        "scan_star": _with("SELECT 'fact_trips' AS table_name, COUNT(*) AS row_count FROM fact_trips UNION ALL "
                           "SELECT 'dim_datetime', COUNT(*) FROM dim_datetime UNION ALL "
                           "SELECT 'dim_payment', COUNT(*) FROM dim_payment"),
        "roundtrip_fact": _with(f"SELECT {FACT_OUTPUT} FROM fact_trips"),
        "dynamic_overwrite": _with(f"SELECT {FACT_OUTPUT} FROM fact_trips"),
        # business queries
        "q1_hour_weekday_volume_fare": _with(
            f"SELECT * FROM q1 ORDER BY {_WEEKDAY}, pickup_hour", queries=True),
        "q2_distance_fare_correlation": _with("SELECT * FROM q2 ORDER BY distance_bin", queries=True),
        "q3_payment_preference_time_location": _with("SELECT * FROM q3", queries=True),
        "q4_avg_tip_by_segments": _with("SELECT * FROM q4", queries=True),
        "q5_top_location_pairs": _with("SELECT * FROM q5", queries=True),
        "export_csv": _with("SELECT * FROM q1", queries=True),
        # chart feeds
        "feed_line": _with(f"SELECT * FROM q1 WHERE pickup_weekday IN ({top4})", queries=True),
        "feed_bar": _with("SELECT *, CAST(PULocationID AS VARCHAR) || '→' || CAST(DOLocationID AS VARCHAR) AS location_pair "
                          "FROM q5 ORDER BY pair_rank, PULocationID, DOLocationID LIMIT 10", queries=True),
        "feed_scatter": _with("SELECT q2.*, (SELECT distance_fare_corr FROM q2 ORDER BY distance_bin LIMIT 1) "
                              "AS first_bin_corr FROM q2", queries=True),
        "feed_payment": _with("SELECT *, 'L' || CAST(PULocationID AS VARCHAR) || '-H' || CAST(pickup_hour AS VARCHAR) AS slot "
                              "FROM q3 ORDER BY trip_count DESC, PULocationID, pickup_hour, payment_desc LIMIT 12",
                              queries=True),
        "feed_tip": _with("SELECT * FROM q4 ORDER BY avg_tip DESC, payment_desc, distance_bucket, VendorID LIMIT 12",
                          queries=True),
        # extensions
        "ext_future_fix": _raw_with(f"""
, d AS (SELECT DISTINCT * FROM raw_trips),
k AS (SELECT *, hour(tpep_pickup_datetime) AS h, dayofweek(tpep_pickup_datetime) AS dow,
             epoch_us(tpep_pickup_datetime) AS us,
             tpep_pickup_datetime > TIMESTAMP '{FUTURE_AS_OF}' AS fut FROM d),
m AS (SELECT h, dow, quantile_disc(us, 0.5) AS med FROM k WHERE NOT fut GROUP BY h, dow)
SELECT {RAW}, CASE WHEN fut AND m.med IS NOT NULL THEN make_timestamp(m.med) ELSE tpep_pickup_datetime END
       AS pickup_fixed
FROM k LEFT JOIN m USING (h, dow)""".replace("\n, d AS", ", d AS", 1)),
        "ext_mode_impute": _raw_with(f"""
, d AS (SELECT DISTINCT * FROM raw_trips),
{_modes()}
SELECT coalesce(VendorID, (SELECT v FROM mode_VendorID)) AS VendorID, tpep_pickup_datetime, tpep_dropoff_datetime,
       passenger_count, trip_distance, fare_amount, tip_amount,
       coalesce(payment_type, (SELECT v FROM mode_payment_type)) AS payment_type,
       coalesce(PULocationID, (SELECT v FROM mode_PULocationID)) AS PULocationID,
       coalesce(DOLocationID, (SELECT v FROM mode_DOLocationID)) AS DOLocationID
FROM d"""),
        "ext_ffill": _raw_with(f"""
, d AS (SELECT DISTINCT * FROM raw_trips)
SELECT {RAW}, coalesce(tpep_pickup_datetime, last_value(tpep_pickup_datetime IGNORE NULLS) OVER (
    PARTITION BY VendorID ORDER BY {_FFILL_ORDER}
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS pickup_filled
FROM d"""),
    }

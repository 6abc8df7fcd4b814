"""Command-line jobs (``spark-submit -m``-style entry points).

    python -m tripstar.cli ingest    --src FILE_OR_DIR --raw-base DIR [--year 2024 --month 1]
    python -m tripstar.cli profile   --raw PATH --out DIR [--as-of TS]
    python -m tripstar.cli etl       --raw PATH --out DIR [--year 2024 --month 1] [--keys stable|parity] [--approx-accuracy N]
    python -m tripstar.cli analytics --warehouse DIR --out DIR

Paths default to the environment variables ``TRIPSTAR_RAW_BASE``,
``TRIPSTAR_WAREHOUSE`` and ``TRIPSTAR_OUTPUTS``; any Hadoop-FS URI works.
Exit code 0 on success, 1 when the gate or a step fails.
"""

from __future__ import annotations

import argparse
import os
import sys

from tripstar.session import build_session


def _ingest(spark, args) -> int:
    from tripstar.sources import landing
    passed, reports = landing.land_checked(spark, args.src, args.raw_base, args.year, args.month)
    for report in reports:
        report.show(truncate=False)
    return 0 if passed else 1


def _profile(spark, args) -> int:
    from tripstar.operators import profile
    from tripstar.sources.sinks import write_csv
    from tripstar.sources.tables import read_raw
    df = profile.profile_frame(read_raw(spark, args.raw))
    for name, rep in profile.profile_reports(df, args.as_of).items():
        write_csv(rep, f"{args.out}/{name}", single_file=True)
    return 0


def _etl(spark, args) -> int:
    from tripstar.plans.etl import LoadFailed, run_etl
    from tripstar.sources.tables import read_raw
    try:
        result = run_etl(spark, read_raw(spark, args.raw), args.out, keys=args.keys,
                         accuracy=args.approx_accuracy, load_month=args.year * 100 + args.month)
    except LoadFailed as exc:
        print(f"load failed: {exc}", file=sys.stderr)
        return 1
    result.load_check.show(truncate=False)
    result.validation.show(truncate=False)
    return 0


def _analytics(spark, args) -> int:
    from tripstar.plans import analytics, feeds
    from tripstar.plans.etl import read_warehouse
    from tripstar.sources.sinks import write_csv
    t = read_warehouse(spark, args.warehouse)
    # Query results are bounded (HAVING / LIMIT / hour grain): cache them so
    # the chart feeds do not recompute the queries.
    results = {name: df.cache() for name, df in
               analytics.run_queries(t["fact_trips"], t["dim_datetime"], t["dim_payment"]).items()}
    for name, df in results.items():
        write_csv(df, f"{args.out}/{name}", single_file=True)
    chart_feeds = {
        "feed_line": feeds.feed_line(results["q1_hour_weekday_volume_fare"]),
        "feed_bar": feeds.feed_bar(results["q5_top_location_pairs"]),
        "feed_scatter": feeds.feed_scatter(results["q2_distance_fare_correlation"]),
        "feed_payment": feeds.feed_payment(results["q3_payment_preference_time_location"]),
        "feed_tip": feeds.feed_tip(results["q4_avg_tip_by_segments"]),
    }
    for name, df in chart_feeds.items():
        write_csv(df, f"{args.out}/{name}", single_file=True)
    return 0


def main(argv: list[str] | None = None, spark=None) -> int:
    env = os.environ.get
    p = argparse.ArgumentParser(prog="tripstar")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("ingest")
    s.add_argument("--src", required=True)
    s.add_argument("--raw-base", default=env("TRIPSTAR_RAW_BASE"))
    s.add_argument("--year", type=int, default=2024)
    s.add_argument("--month", type=int, default=1)
    s = sub.add_parser("profile")
    s.add_argument("--raw", default=env("TRIPSTAR_RAW_BASE"))
    s.add_argument("--out", default=env("TRIPSTAR_OUTPUTS"))
    s.add_argument("--as-of", default=None)
    s = sub.add_parser("etl")
    s.add_argument("--raw", default=env("TRIPSTAR_RAW_BASE"))
    s.add_argument("--out", default=env("TRIPSTAR_WAREHOUSE"))
    s.add_argument("--year", type=int, default=2024, help="with --month, the load that is replaced")
    s.add_argument("--month", type=int, default=1)
    s.add_argument("--keys", choices=("parity", "stable"), default="stable")
    s.add_argument("--approx-accuracy", type=int, default=None,
                   help="use percentile_approx with this accuracy instead of exact quantiles")
    s = sub.add_parser("analytics")
    s.add_argument("--warehouse", default=env("TRIPSTAR_WAREHOUSE"))
    s.add_argument("--out", default=env("TRIPSTAR_OUTPUTS"))
    args = p.parse_args(argv)
    missing = [k for k, v in vars(args).items() if v is None and k not in ("as_of", "approx_accuracy")]
    if missing:
        p.error(f"missing paths: {', '.join(missing)}")
    own = spark is None
    spark = spark or build_session(app_name=f"tripstar-{args.job}")
    try:
        return {"ingest": _ingest, "profile": _profile, "etl": _etl, "analytics": _analytics}[args.job](spark, args)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())

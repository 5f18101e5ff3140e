"""Command line: the scheduled jobs of the source system as Spark jobs.

    python -m foehn load --tier now --landing L --warehouse W
    python -m foehn refresh --landing L --warehouse W [--days 2024-01-01,2024-01-02]
    python -m foehn silver --warehouse W [--days ...]
    python -m foehn stream --tier recent --landing L --warehouse W --checkpoint C [--every "10 minutes"]
    python -m foehn report canton-daily --warehouse W --as-of 2024-01-30 --out PATH

Under ``spark-submit`` the cluster settings (master, checkpoint folder)
come from the submit configuration; nothing here assumes a local machine.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _days(text: str | None):
    return None if not text else [dt.date.fromisoformat(t) for t in text.split(",") if t]


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="foehn")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load")
    p.add_argument("--tier", required=True, choices=["historical", "recent", "now", "stations"])
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p = sub.add_parser("refresh")
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--days")
    p = sub.add_parser("silver")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--days")
    p = sub.add_parser("stream")
    p.add_argument("--tier", required=True, choices=["recent", "now"])
    p.add_argument("--landing", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--every", help="processing-time trigger; default: process what is available and stop")
    p = sub.add_parser("report")
    p.add_argument("name", choices=["canton-daily", "daily-station", "monthly-station", "completeness-per-day"])
    p.add_argument("--warehouse", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from .plans import bronze, refresh, silver
    from .session import build_session

    spark = build_session(app_name=f"foehn-{args.cmd}")
    if args.cmd == "load":
        paths = refresh.paths(args.warehouse)
        fn = {
            "historical": bronze.load_historical,
            "recent": bronze.load_recent,
            "now": bronze.load_now,
            "stations": bronze.load_stations,
        }[args.tier]
        rows = fn(spark, args.landing, paths[args.tier], ledger_root=paths["ledger"]).collect()
    elif args.cmd == "refresh":
        rows = refresh.refresh_all(spark, args.landing, args.warehouse, silver_days=_days(args.days)).collect()
    elif args.cmd == "silver":
        p = refresh.paths(args.warehouse)
        path = silver.refresh_silver(spark, refresh.bronze_tables(spark, args.warehouse), p["silver"], _days(args.days))
        rows = [{"silver_version": path}]
    elif args.cmd == "stream":
        from .streaming import ingest

        p = refresh.paths(args.warehouse)
        trigger = {"processingTime": args.every} if args.every else {"availableNow": True}
        if args.tier == "now":
            q = ingest.start_now_ingest(spark, args.landing, p["now"], args.checkpoint, trigger)
        else:

            def to_silver(days):
                silver.refresh_silver(spark, refresh.bronze_tables(spark, args.warehouse), p["silver"], days)

            q = ingest.start_recent_ingest(spark, args.landing, p["recent"], args.checkpoint, to_silver, trigger)
        q.awaitTermination()
        rows = [{"stream": args.tier, "status": "stopped"}]
    else:
        from .plans import analytics, quality

        as_of = dt.date.fromisoformat(args.as_of)
        std, _, dim = refresh.gold_views(spark, args.warehouse)
        df = {
            "canton-daily": lambda: analytics.canton_daily(std, dim, as_of),
            "daily-station": lambda: analytics.daily_station(std, as_of),
            "monthly-station": lambda: analytics.monthly_station(std, dim, as_of.year),
            "completeness-per-day": lambda: quality.completeness_per_day(std, as_of),
        }[args.name]()
        df.write.mode("overwrite").parquet(args.out)
        rows = [{"report": args.name, "out": args.out}]
    for r in rows:
        print(json.dumps(r.asDict() if hasattr(r, "asDict") else r, default=str))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

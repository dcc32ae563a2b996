"""The daily job from the command line: ``spark-submit -m`` style, see ``--help``."""

from __future__ import annotations

import argparse
from datetime import datetime

from .plans.daily_run import run_daily
from .session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vuelometria", description="Ingest the feeds and refresh the models.")
    for name in ("raw", "processed", "curated", "checkpoint"):
        parser.add_argument(name, help=f"{name} location")
    parser.add_argument("--as-of", help="date of incidents whose pull carries none (YYYY-MM-DD)")
    parser.add_argument("--since", type=datetime.fromisoformat, help="start of the last successful run (ISO, with zone)")
    parser.add_argument("--city", help="weather city of the daily fact; without it one row per city")
    parser.add_argument("--cities", help="Parquet with airport_iata and ciudad; keeps the per-flight fact")
    parser.add_argument("--cases", help="Parquet with incident_id and case columns; keeps the incident fact")
    parser.add_argument("--quarantine", help="where documents go that are no JSON; without it they fail their feed")
    args = parser.parse_args(argv)
    spark = build_session("vuelometria-daily")
    cities = spark.read.parquet(args.cities) if args.cities else None
    cases = spark.read.parquet(args.cases) if args.cases else None
    report = run_daily(
        spark, args.raw, args.processed, args.curated, args.checkpoint, args.as_of, args.since, args.city, cities,
        args.quarantine, cases,
    )
    for feed in report.feeds:
        print(f"{feed.feed}: {feed.rows} rows" + f", {feed.quarantined} documents put aside" * bool(feed.quarantined))
    print(f"started {report.started_at.isoformat()}")


if __name__ == "__main__":
    main()

"""Command line for the three entry points of the audit.

    python -m tripaudit audit  --raw RAW --out OUT [--weather 'W/*.json' --weather-year 2025] [--sampled]
    python -m tripaudit audit  --intake TABLE --out OUT
    python -m tripaudit links  --pages 'PAGES/*.html' --years 2024 2025 [--fleets yellow green]
                               [--month-token _2023-12 --month-years 2023] [--out MAP]
    python -m tripaudit intake --raw RAW --out TABLE [--fleets yellow green]

``audit`` runs the whole audit and returns 1 when anything was left out;
``links`` writes the filename -> url map harvested from landed pages and
prints its first rows; ``intake`` takes in files that landed since
the last run (Structured Streaming, available-now trigger).  The session
comes from the submitting environment (master, memory and
``spark.checkpoint.dir`` are the cluster's).  A bare ``--raw/--out`` call
means ``audit``.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from tripaudit.config import AuditConfig


def _audit(spark: SparkSession, args) -> int:
    if not (args.raw or args.intake):
        raise SystemExit("audit needs --raw or --intake")
    from tripaudit.plans.audit_run import preview, run_audit
    from tripaudit.sources.weather import load_weather
    from tripaudit.sources.zones import load_zones, zones_of
    from tripaudit.streaming import read_history, read_intake

    cfg = AuditConfig(
        impute_year=args.impute_year, impute_month=args.impute_month, fleets=tuple(args.fleets),
        speed_limit_mph=args.speed_limit, min_trip_seconds=args.min_seconds, short_trip_fare=args.short_fare,
        present_threshold=args.present_threshold, weather_year=args.weather_year)
    if args.zones:
        zones = load_zones(spark, args.zones)
        ids = (zones_of(zones, *args.boroughs) if args.boroughs else zones).select("LocationID").distinct()
        cfg = cfg.with_(zone_ids=tuple(sorted(r[0] for r in ids.collect())))  # a few hundred zones
    weather = load_weather(spark, args.weather) if args.weather else None
    intake = read_intake(spark, args.intake, cfg.fleets) if args.intake else None
    res = run_audit(spark, args.raw, args.out, cfg, weather=weather, intake=intake,
                    impute_mode="sampled" if args.sampled else "exact", keep_staged=args.keep_staged,
                    skip_failed_fleets=args.skip_failed_fleets, skip_failed_reports=args.skip_failed_reports,
                    ignore_corrupt_files=args.ignore_corrupt_files, quarantine_files=args.quarantine_files,
                    store=args.store, history=read_history(spark, args.intake) if args.intake else None)
    print(json.dumps({
        "complete": res.complete, "staged": res.staged_path, "audit": res.audit_path, "reports": res.reports,
        "imputation": res.imputation and res.imputation._asdict(), "skipped_fleets": res.skipped_fleets,
        "quarantined": res.quarantined, "reused_batches": res.reused_batches,
        "failed_reports": res.failed_reports, "ids_set_null": res.ids_lost,
        "weather_days_unread": res.unread_weather_days, "corrupt_files_ignored": res.corrupt_files_ignored}))
    if not args.quiet:
        preview(res)
    return 0 if res.complete else 1


def _links(spark: SparkSession, args) -> int:
    from tripaudit.sources.links import (
        filter_links,
        harvest_links,
        load_pages,
        narrow_links,
        overlay_links,
    )

    links = harvest_links(load_pages(spark, args.pages))
    found = filter_links(links, args.years, args.fleets, args.suffix)
    if args.month_token:
        extra = narrow_links(filter_links(links, args.month_years or args.years, args.fleets,
                                          args.suffix), args.month_token)
        found = overlay_links(found, extra)
    if args.out:
        found.write.mode("overwrite").option("header", True).csv(args.out)
        found = spark.read.schema(found.schema).option("header", True).csv(args.out)
    for row in found.orderBy("filename").limit(args.show).collect():
        print(f"{row.filename}\t{row.url}")
    return 0


def _intake(spark: SparkSession, args) -> int:
    from tripaudit.streaming import start_intake

    for q in start_intake(spark, args.raw, args.out, fleets=tuple(args.fleets),
                          checkpoint=args.checkpoint, available_now=True,
                          max_files_per_trigger=args.max_files):
        q.awaitTermination()
    return 0


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tripaudit", description=__doc__.splitlines()[0])
    sub = ap.add_subparsers(dest="command", required=True)

    a = sub.add_parser("audit", help="run the whole audit")
    a.add_argument("--raw", help="directory of *_tripdata_YYYY-MM.parquet files")
    a.add_argument("--intake", help="flagged trip table of the intake command, instead of raw files (with --raw, "
                                    "those only answer for a history month without trips)")
    a.add_argument("--out", required=True, help="output directory (audit/ and aggregated/)")
    a.add_argument("--weather", help="landed weather JSON files (one document per file)")
    a.add_argument("--fleets", nargs="+", default=["yellow", "green"])
    a.add_argument("--impute-year", type=int, default=AuditConfig.impute_year)
    a.add_argument("--impute-month", type=int, default=AuditConfig.impute_month)
    a.add_argument("--sampled", action="store_true", help="Poisson sample instead of exact")
    a.add_argument("--speed-limit", type=float, default=AuditConfig.speed_limit_mph, help="rule A, miles per hour")
    a.add_argument("--min-seconds", type=int, default=AuditConfig.min_trip_seconds, help="rule B, shortest trip")
    a.add_argument("--short-fare", type=float, default=AuditConfig.short_trip_fare, help="rule B, fare of a short trip")
    a.add_argument("--present-threshold", type=int, default=AuditConfig.present_threshold,
                   help="a target month with more rows is not imputed")
    a.add_argument("--weather-year", type=int, help="join the days of this year only")
    a.add_argument("--zones", help="landed zone archives (zipped shapefiles) that define the priced zone")
    a.add_argument("--boroughs", nargs="+", help="only the zones of these boroughs")
    a.add_argument("--keep-staged", action="store_true", help="leave the staged table for further reading")
    a.add_argument("--skip-failed-fleets", action="store_true", help="leave out and list fleets that fail")
    a.add_argument("--skip-failed-reports", action="store_true", help="leave out and list reports that fail")
    a.add_argument("--ignore-corrupt-files", action="store_true", help="skip unreadable files")
    a.add_argument("--quarantine-files", action="store_true", help="leave out and list files that cannot be read")
    a.add_argument("--store", help="folder that keeps staged batches; a rerun stages new and changed files only")
    a.add_argument("--quiet", action="store_true", help="no preview of the small reports")

    lk = sub.add_parser("links", help="list trip-file links found in landed pages")
    lk.add_argument("--pages", required=True, help="landed HTML files")
    lk.add_argument("--years", nargs="+", required=True)
    lk.add_argument("--fleets", nargs="+", default=["yellow", "green"])
    lk.add_argument("--suffix", default=".parquet")
    lk.add_argument("--month-token", help="also take names containing this token, e.g. _2023-12")
    lk.add_argument("--month-years", nargs="+", help="years searched for --month-token")
    lk.add_argument("--out", help="write the link map here as CSV")
    lk.add_argument("--show", type=int, default=50, help="links to print")

    i = sub.add_parser("intake", help="take in newly landed trip files")
    i.add_argument("--raw", required=True)
    i.add_argument("--out", required=True, help="flagged trip table (Parquet)")
    i.add_argument("--fleets", nargs="+", default=["yellow", "green"])
    i.add_argument("--checkpoint", help="stream checkpoint folder (default: under spark.checkpoint.dir)")
    i.add_argument("--max-files", type=int, help="files per micro-batch")
    return ap


def main(argv=None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    if argv and argv[0].startswith("--"):
        argv = ["audit", *argv]  # bare flags: the whole audit
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("tripaudit").getOrCreate()
    return {"audit": _audit, "links": _links, "intake": _intake}[args.command](spark, args)


if __name__ == "__main__":
    raise SystemExit(main())

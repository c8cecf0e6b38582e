"""Readers and writers: fleet Parquet intake, weather JSON, crawled links,
report files, and adapters over the shared test tables."""

from tripaudit.sources.files import read_csv, read_reports, write_csv, write_parquet
from tripaudit.sources.footers import (
    check_files,
    damaged_files,
    file_report,
    list_files,
    plan_files,
    read_group,
)
from tripaudit.sources.ledger import compare_ledgers, read_ledger, read_taken, take_in, upsert_stream
from tripaudit.sources.links import (
    filter_links,
    harvest_links,
    load_pages,
    narrow_links,
    new_intake,
    new_links,
    overlaid_links,
    overlay_links,
)
from tripaudit.sources.trips import (
    count_history_files,
    load_trips,
    read_fleet,
    source_counts,
    union_fleets,
)
from tripaudit.sources.weather import in_year, load_weather, unread_days, weather_rows
from tripaudit.sources.zones import load_zones, zones_of

__all__ = [
    "check_files",
    "compare_ledgers",
    "count_history_files",
    "damaged_files",
    "file_report",
    "filter_links",
    "harvest_links",
    "in_year",
    "list_files",
    "load_pages",
    "load_trips",
    "load_weather",
    "load_zones",
    "narrow_links",
    "new_intake",
    "new_links",
    "overlaid_links",
    "overlay_links",
    "plan_files",
    "read_csv",
    "read_fleet",
    "read_group",
    "read_ledger",
    "read_reports",
    "read_taken",
    "source_counts",
    "take_in",
    "union_fleets",
    "unread_days",
    "upsert_stream",
    "weather_rows",
    "write_csv",
    "write_parquet",
    "zones_of",
]

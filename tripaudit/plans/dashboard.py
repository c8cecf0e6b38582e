"""Dashboard read path: the report CSVs of an audit run read back into
Spark and turned into the frames the dashboard plots (yearly volume,
speed grid, monthly money series, rain correlation and trend).

Each report is read with its declared schema; a missing or different one raises, or is left
out and listed where the caller asks for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripaudit.operators import (
    rain_elasticity,
    rain_trend,
    tip_series,
    velocity_pivot,
    volume_by_year,
)
from tripaudit.sources.files import Reports, read_reports


# Report layouts written by ``run_audit`` (file name -> DDL columns).
REPORT_SCHEMAS: dict[str, str] = {
    "yellow_green_volume": "year int, quarter int, taxi_type string, count bigint",
    "velocity_heatmap": "hour int, day_of_week int, avg_speed double",
    "tip_vs_surcharge": "year int, month int, avg_surcharge double, avg_tip_amount double",
    "weather_elasticity": "date date, total_trips bigint, precipitation double",
    "q1_comparison": "year int, month int, taxi_type string, count bigint",
    "ghost_vendors": "vendor_id int, count bigint",
}


def load_dashboard(spark: SparkSession, out_dir: str, skip_failed: bool = False) -> Reports:
    """Report frames plus the dashboard's derived frames, and the reports left out."""
    base = out_dir.rstrip("/") + "/aggregated"
    frames, failed = read_reports(spark, {k: f"{base}/{k}" for k in REPORT_SCHEMAS}, REPORT_SCHEMAS, skip_failed)
    derived: dict[str, DataFrame] = {}
    if "yellow_green_volume" in frames:
        derived["volume_by_year"] = volume_by_year(frames["yellow_green_volume"])
    if "velocity_heatmap" in frames:
        derived["velocity_pivot"] = velocity_pivot(frames["velocity_heatmap"])
    if "tip_vs_surcharge" in frames:
        derived["tip_series"] = tip_series(frames["tip_vs_surcharge"])
    if "weather_elasticity" in frames:
        derived["rain_correlation"] = rain_elasticity(frames["weather_elasticity"])
        derived["rain_trend"] = rain_trend(frames["weather_elasticity"])
    return Reports({**frames, **derived}, failed)

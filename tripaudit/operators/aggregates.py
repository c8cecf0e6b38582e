"""Calendar and location aggregates over trip frames (AGG-2..7, 11, 16).

Each is a single hash aggregate (partial on the map side, final after one
shuffle on a handful of low-cardinality keys); the scan reads only the
columns named here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _n():
    return F.count(F.lit(1))


def period_summary(trips: DataFrame, use_partition_columns: bool = False) -> DataFrame:
    """Rows per (year, month) of pick-up, ascending.  On a staged table whose
    ``year``/``month`` partition columns were derived from the pick-up time,
    ``use_partition_columns`` groups by them, so the scan reads no
    timestamp column at all."""
    keys = ([F.col("year"), F.col("month")] if use_partition_columns else
            [F.year("pickup_time").alias("year"), F.month("pickup_time").alias("month")])
    return trips.groupBy(*keys).agg(_n().alias("count")).orderBy("year", "month")


def volume_by_quarter(trips: DataFrame) -> DataFrame:
    """Rows per (year, quarter, taxi_type)."""
    return (trips.groupBy(F.year("pickup_time").alias("year"),
                          F.quarter("pickup_time").alias("quarter"),
                          "taxi_type")
            .agg(_n().alias("count")))


def volume_by_year(quarterly: DataFrame) -> DataFrame:
    """Yearly roll-up of the quarterly volumes per fleet."""
    return (quarterly.groupBy("year", "taxi_type")
            .agg(F.sum("count").cast("bigint").alias("count")))


def velocity_heatmap(marked: DataFrame) -> DataFrame:
    """Average speed of zone trips per (hour, day_of_week; 1 = Sunday)."""
    if "inside_zone" not in marked.columns:
        raise ValueError("frame has no inside_zone column; call mark_zone first")
    return (marked.filter(F.col("inside_zone"))
            .groupBy(F.hour("pickup_time").alias("hour"),
                     F.dayofweek("pickup_time").alias("day_of_week"))
            .agg(F.avg("speed_mph").alias("avg_speed")))


def tip_vs_surcharge(trips: DataFrame) -> DataFrame:
    """Monthly average surcharge and average "tip" proxy (total - fare;
    it includes taxes, tolls and the surcharge)."""
    return (trips.groupBy(F.year("pickup_time").alias("year"),
                          F.month("pickup_time").alias("month"))
            .agg(F.avg("congestion_surcharge").alias("avg_surcharge"),
                 F.avg(F.col("total_amount") - F.col("fare")).alias("avg_tip_amount")))


def border_effect(trips: DataFrame) -> DataFrame:
    """Drop-offs per (location, year); a NULL location is its own group."""
    return (trips.groupBy("dropoff_loc", F.year("pickup_time").alias("year"))
            .agg(_n().alias("count")))


def q1_comparison(trips: DataFrame) -> DataFrame:
    """January-March rows per (year, month, taxi_type), ordered."""
    return (trips.filter(F.month("pickup_time") <= 3)
            .groupBy(F.year("pickup_time").alias("year"),
                     F.month("pickup_time").alias("month"), "taxi_type")
            .agg(_n().alias("count"))
            .orderBy("year", "month", "taxi_type"))


def daily_trips(trips: DataFrame) -> DataFrame:
    """Trips per pick-up day: ``date, total_trips``."""
    return (trips.groupBy(F.to_date("pickup_time").alias("date"))
            .agg(_n().alias("total_trips")))

"""Trip metrics and the three ghost rules as Column expressions.

All of them are plain arithmetic/comparisons, so they stay inside
whole-stage codegen and fold into the scan's Project/Filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT, AuditConfig


def duration_seconds(pickup: str = "pickup_time", dropoff: str = "dropoff_time") -> Column:
    """Whole seconds between the two stamps (each floored to the second);
    negative when the drop-off precedes the pick-up, NULL if either is NULL."""
    return F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)


def duration_hours(seconds: Column | str = "duration_seconds") -> Column:
    c = F.col(seconds) if isinstance(seconds, str) else seconds
    return c / F.lit(3600.0)


def speed_mph(distance: Column | str = "trip_distance", hours: Column | str = "duration_hours",
              cfg: AuditConfig = DEFAULT) -> Column:
    """distance / hours when hours exceed the cut, else 0 (also for NULL
    hours); NULL distance over a valid duration stays NULL."""
    d = F.col(distance) if isinstance(distance, str) else distance
    h = F.col(hours) if isinstance(hours, str) else hours
    return F.when(h > F.lit(cfg.min_hours_for_speed), d / h).otherwise(F.lit(0.0))


def rule_fast(cfg: AuditConfig = DEFAULT) -> Column:
    """Rule A: implausible average speed."""
    return F.col("speed_mph") > F.lit(cfg.speed_limit_mph)


def rule_short_expensive(cfg: AuditConfig = DEFAULT) -> Column:
    """Rule B: very short trip with a high fare."""
    return ((F.col("duration_seconds") < F.lit(cfg.min_trip_seconds))
            & (F.col("fare") > F.lit(cfg.short_trip_fare)))


def rule_zero_distance(cfg: AuditConfig = DEFAULT) -> Column:
    """Rule C: no distance but a positive fare."""
    return (F.col("trip_distance") == F.lit(0.0)) & (F.col("fare") > F.lit(0.0))


def ghost_flag(cfg: AuditConfig = DEFAULT) -> Column:
    """Three-valued ghost flag: TRUE (audit), FALSE (clean), NULL
    (undetermined: no rule fires and at least one is unknown)."""
    return rule_fast(cfg) | rule_short_expensive(cfg) | rule_zero_distance(cfg)

"""Ghost-trip split with full row accounting (FLW-1, PRJ-6..8, FLT-1..4,
AGG-1/10/15)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT, AuditConfig
from tripaudit.functions.trips import (
    duration_hours,
    duration_seconds,
    ghost_flag,
    rule_fast,
    rule_short_expensive,
    rule_zero_distance,
    speed_mph,
)


class GhostSplit(NamedTuple):
    clean: DataFrame
    audit: DataFrame
    undetermined: DataFrame


def derive_metrics(trips: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Add ``duration_seconds``, ``duration_hours`` and ``speed_mph`` in one
    projection (the shared sub-expressions are evaluated once in codegen)."""
    secs = duration_seconds()
    hours = duration_hours(secs)
    return trips.select("*", secs.alias("duration_seconds"), hours.alias("duration_hours"),
                        speed_mph("trip_distance", hours, cfg).alias("speed_mph"))


def flag_ghosts(trips: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """Metrics plus the three-valued ``is_ghost`` flag."""
    return derive_metrics(trips, cfg).withColumn("is_ghost", ghost_flag(cfg))


def split_ghosts(trips: DataFrame, cfg: AuditConfig = DEFAULT) -> GhostSplit:
    """Three disjoint frames that add up to the input: clean (no rule
    fires), audit (some rule fires), undetermined (no rule fires but one
    is unknown because of a NULL input).  All three are filters over one
    derived plan; persist the input if more than one is consumed."""
    flagged = flag_ghosts(trips, cfg)
    g = F.col("is_ghost")
    return GhostSplit(
        clean=flagged.filter(~g).drop("is_ghost"),
        audit=flagged.filter(g).drop("is_ghost"),
        undetermined=flagged.filter(g.isNull()).drop("is_ghost"),
    )


def filter_ghost_trips(trips: DataFrame, cfg: AuditConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """``(clean, audit)`` pair, the two-way form of :func:`split_ghosts`."""
    s = split_ghosts(trips, cfg)
    return s.clean, s.audit


def row_accounting(trips: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """One row of counts from a single pass: total, clean, audit,
    undetermined and hits per rule (a trip may hit several rules)."""
    m = derive_metrics(trips, cfg)
    g = ghost_flag(cfg)

    def n(cond):
        return F.count(F.when(cond, F.lit(1)))

    return m.agg(
        F.count(F.lit(1)).alias("total"),
        n(~g).alias("clean"),
        n(g).alias("audit"),
        n(g.isNull()).alias("undetermined"),
        n(rule_fast(cfg)).alias("rule_a"),
        n(rule_short_expensive(cfg)).alias("rule_b"),
        n(rule_zero_distance(cfg)).alias("rule_c"),
    )


def ghost_vendors(audit: DataFrame, k: int = DEFAULT.top_vendors) -> DataFrame:
    """Top-k vendors by ghost-trip count, ties broken by vendor id."""
    return (audit.groupBy("vendor_id").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("vendor_id"))
            .limit(k))

"""Mergeable partial aggregates of flagged trips (FLW-4, AGG-2..11, SRC-4).

``partial_states`` goes over flagged trips once and leaves a small table of sums and counts.
Every report of the audit is merged from such tables alone, by adding them up: a batch of
trips that lands later adds its own partials, and nothing already counted is read again.

A state belongs to one grain:

* ``hour``: fleet, status, origin (real or imputed), pick-up day and hour, zone flag; it
  carries the row count, paid trips, and sum and count of surcharge, tip and speed.
* ``pickup``: leaking zone trips by pick-up location and month.
* ``dropoff``: clean trips by drop-off location and month.
* ``vendor``: ghost trips by vendor and month.

A trip becomes one ``hour`` row and at most three more, which meet in one hash aggregate with
a partial step on the map side.  The table grows with days, hours and locations, not with
trips.  Averages are kept as sum and count, so that merging stays exact up to the order in
which doubles are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT, AuditConfig

KEYS = "grain string, taxi_type string, status string, is_imputed boolean, day date, hour int, inside_zone boolean, place int"
MEASURES = {
    "n": "bigint", "paid": "bigint",
    "surcharge_sum": "double", "surcharge_n": "bigint",
    "tip_sum": "double", "tip_n": "bigint",
    "speed_sum": "double", "speed_n": "bigint",
}
KEY_NAMES = [k.split()[0] for k in KEYS.split(", ")]
SCHEMA = f"{KEYS}, " + ", ".join(f"{k} {t}" for k, t in MEASURES.items())


def _state(grain: str, **columns: str) -> str:
    """SQL of a struct with all keys and measures; those not given are NULL."""
    given = {"grain": f"'{grain}'", **columns}
    return "named_struct({})".format(", ".join(
        f"'{name}', CAST({given.get(name, 'NULL')} AS {kind})" for name, kind in (c.split() for c in SCHEMA.split(", "))))


_TIP, _MONTH = "total_amount - fare", "trunc(pickup_time, 'MM')"
#: What one flagged trip adds, as an array of states.  One SQL text, as it is planned for
#: every batch and hundreds of Column calls would cost more than a small batch's scan.
_STATES = "array_compact(array({}))".format(", ".join((
    _state("hour", taxi_type="taxi_type", status="status", is_imputed="is_imputed", day="to_date(pickup_time)",
           hour="hour(pickup_time)", inside_zone="inside_zone", n="1", paid="if(congestion_surcharge > 0, 1, 0)",
           surcharge_sum="congestion_surcharge", surcharge_n="if(congestion_surcharge IS NULL, 0, 1)",
           tip_sum=_TIP, tip_n=f"if({_TIP} IS NULL, 0, 1)",
           speed_sum="speed_mph", speed_n="if(speed_mph IS NULL, 0, 1)"),
    f"if(status = 'clean' AND inside_zone AND congestion_surcharge = 0, "
    f"{_state('pickup', day=_MONTH, place='pickup_loc', n='1')}, NULL)",
    f"if(status = 'clean', {_state('dropoff', day=_MONTH, place='dropoff_loc', n='1')}, NULL)",
    f"if(status = 'audit', {_state('vendor', day=_MONTH, place='vendor_id', n='1')}, NULL)")))


def partial_states(flagged: DataFrame) -> DataFrame:
    """Partials of flagged trips (``status``, ``is_imputed``, ``inside_zone`` and metrics as in
    the staged table), in one pass."""
    return merge_states(flagged.selectExpr(f"inline({_STATES})"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state per key: partials of several batches added up."""
    return states.groupBy(*KEY_NAMES).agg(*[F.expr(f"sum({m})").alias(m) for m in MEASURES])


def _grain(states: DataFrame, grain: str) -> DataFrame:
    return states.filter(F.col("grain") == grain)


def _sum(name: str = "n") -> Column:
    return F.sum(name).cast("bigint")


def _mean(name: str) -> Column:
    """NULL where nothing was known."""
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def _year() -> Column:
    return F.year("day").alias("year")


def merged_daily(states: DataFrame) -> DataFrame:
    """Clean trips per pick-up day, as ``daily_trips``."""
    hours = _grain(states, "hour").filter(F.col("status") == "clean")
    return hours.groupBy(F.col("day").alias("date")).agg(_sum().alias("total_trips"))


def merged_accounting(states: DataFrame) -> DataFrame:
    """Rows per fleet and origin, split by status, with zone trips among the clean, as
    ``staged_accounting``."""
    def n(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    clean = F.col("status") == "clean"
    return _grain(states, "hour").groupBy("taxi_type", "is_imputed").agg(
        _sum().alias("total"), n(clean).alias("clean"), n(F.col("status") == "audit").alias("audit"),
        n(F.col("status") == "undetermined").alias("undetermined"), n(clean & F.col("inside_zone")).alias("clean_in_zone"))


def merged_reports(states: DataFrame, cfg: AuditConfig = DEFAULT) -> dict[str, DataFrame]:
    """The reports of ``audit_reports``, from partials instead of trips."""
    hours = _grain(states, "hour")
    real = hours.filter(~F.col("is_imputed"))  # as loaded, before imputation
    clean = hours.filter(F.col("status") == "clean")
    zone = clean.filter(F.col("inside_zone"))
    year, month, quarter = _year(), F.month("day").alias("month"), F.quarter("day").alias("quarter")

    def top(grain: str, name: str, k: int) -> DataFrame:
        return (_grain(states, grain).groupBy(F.col("place").alias(name)).agg(_sum().alias("count"))
                .orderBy(F.desc("count"), F.asc_nulls_first(name)).limit(k))

    return {
        "source_counts": real.groupBy("taxi_type").agg(_sum().alias("count")),
        "period_summary": real.groupBy(year, month).agg(_sum().alias("count")).orderBy("year", "month"),
        "ghost_vendors": top("vendor", "vendor_id", cfg.top_vendors),
        "surcharge_compliance": zone.groupBy("taxi_type").agg(
            _sum().alias("total_zone_trips"), _sum("paid").alias("paid_surcharge")),
        "audit_leakage": top("pickup", "pickup_loc", cfg.top_leakage),
        "yellow_green_volume": clean.groupBy(year, quarter, "taxi_type").agg(_sum().alias("count")),
        "velocity_heatmap": zone.groupBy("hour", F.dayofweek("day").alias("day_of_week"))
            .agg(_mean("speed").alias("avg_speed")),
        "tip_vs_surcharge": clean.groupBy(year, month).agg(
            _mean("surcharge").alias("avg_surcharge"), _mean("tip").alias("avg_tip_amount")),
        "border_effect": _grain(states, "dropoff").groupBy(F.col("place").alias("dropoff_loc"), year)
            .agg(_sum().alias("count")),
        "q1_comparison": clean.filter(F.month("day") <= 3).groupBy(year, month, "taxi_type")
            .agg(_sum().alias("count")).orderBy("year", "month", "taxi_type"),
    }

"""Priced-zone marking, surcharge compliance and leakage (PRJ-9, JN-3,
FLT-6/7, AGG-8/9)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT, ZONE_IDS


def zone_ids(path: str | None = None) -> list[int]:
    """Zone dimension as a list of location ids (the same list with or
    without a zone file, as in the audited pipeline)."""
    return list(ZONE_IDS)


def mark_zone(trips: DataFrame, ids: Iterable[int] = ZONE_IDS) -> DataFrame:
    """``inside_zone`` = drop-off id in the zone list; NULL id gives NULL.
    The literal list compiles to an INSET hash lookup (no join, no
    shuffle); filters on the flag push into the Parquet scan as ``In``."""
    return trips.withColumn("inside_zone", F.col("dropoff_loc").isin(list(ids)))


def mark_zone_table(trips: DataFrame, zones: DataFrame, id_col: str = "LocationID") -> DataFrame:
    """``inside_zone`` from a zone table instead of a literal list: TRUE when
    the drop-off id is in ``zones[id_col]``, FALSE when not, NULL when the
    id is NULL (the same three values as :func:`mark_zone`).  The planner
    chooses the join; AQE broadcasts the distinct ids when they measure small."""
    ids = zones.select(F.col(id_col).cast("int").alias("_zone_id")).dropna().distinct()
    joined = trips.join(ids, trips["dropoff_loc"] == ids["_zone_id"], "left")
    flag = F.when(F.col("dropoff_loc").isNull(), F.lit(None).cast("boolean")) \
        .otherwise(F.col("_zone_id").isNotNull())
    return joined.withColumn("inside_zone", flag).drop("_zone_id")


def _require_zone(df: DataFrame) -> None:
    if "inside_zone" not in df.columns:
        raise ValueError("frame has no inside_zone column; call mark_zone first")


def surcharge_compliance(marked: DataFrame) -> DataFrame:
    """Per fleet, trips ending in the zone and how many paid a surcharge
    (> 0).  A NULL surcharge counts in the total only."""
    _require_zone(marked)
    return (marked.filter(F.col("inside_zone"))
            .groupBy("taxi_type")
            .agg(F.count(F.lit(1)).alias("total_zone_trips"),
                 F.count(F.when(F.col("congestion_surcharge") > 0, F.lit(1))).alias("paid_surcharge")))


def audit_leakage(marked: DataFrame, k: int = DEFAULT.top_leakage) -> DataFrame:
    """Top-k pick-up locations of zone trips with a zero surcharge (NULL is
    not leakage); ties broken by location id.  Planned as a partial
    aggregate plus a TakeOrderedAndProject."""
    _require_zone(marked)
    return (marked.filter(F.col("inside_zone") & (F.col("congestion_surcharge") == 0))
            .groupBy("pickup_loc").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("pickup_loc"))
            .limit(k))

"""Rain elasticity: daily demand joined to daily precipitation (JN-1,
AGG-12, AGG-17, FLW-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.stats import null_safe_corr


def rain_join(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Inner equi-join on ``date``: ``date, total_trips, precipitation``.

    Both inputs are one row per day.  No broadcast hint: the join side
    sizes are only known after the aggregates run, so the choice is left
    to AQE, which converts to a broadcast hash join when the materialised
    side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and
    keeps a sort-merge join otherwise."""
    return daily.join(weather.select(F.to_date("date").alias("date"), "precipitation"),
                      "date", "inner").select("date", "total_trips", "precipitation")


def rain_elasticity(joined: DataFrame) -> DataFrame:
    """One row: number of complete pairs and their Pearson correlation
    (NULL when undefined: fewer than two pairs or a constant side)."""
    return joined.agg(
        F.count(F.when(F.col("total_trips").isNotNull() & F.col("precipitation").isNotNull(),
                       F.lit(1))).alias("n"),
        null_safe_corr("total_trips", "precipitation").alias("correlation"),
    )


def rain_trend(joined: DataFrame) -> DataFrame:
    """Least-squares line of daily trips on precipitation."""
    y, x = F.col("total_trips").cast("double"), F.col("precipitation")
    return joined.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).cast("bigint").alias("n"),
    )

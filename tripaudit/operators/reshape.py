"""Report reshapes of the small aggregates (RSH-1/2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripaudit.functions.time import month_start

HOURS = list(range(24))


def velocity_pivot(heatmap: DataFrame) -> DataFrame:
    """day_of_week x hour grid of ``avg_speed`` (columns "0".."23"; empty
    cells NULL).  Pivot values are given, so no extra distinct job runs;
    each cell holds one value because the heatmap is keyed by both axes."""
    return (heatmap.groupBy("day_of_week")
            .pivot("hour", HOURS)
            .agg(F.max("avg_speed")))


def tip_series(tips: DataFrame) -> DataFrame:
    """Monthly series dated on the first day of each month."""
    return tips.select(month_start().alias("date"), "avg_surcharge", "avg_tip_amount")

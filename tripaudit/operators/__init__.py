"""Trip-audit operators: each takes and returns DataFrames (lazy)."""

from tripaudit.operators.aggregates import (
    border_effect,
    daily_trips,
    period_summary,
    q1_comparison,
    tip_vs_surcharge,
    velocity_heatmap,
    volume_by_quarter,
    volume_by_year,
)
from tripaudit.operators.ghost import (
    GhostSplit,
    derive_metrics,
    filter_ghost_trips,
    flag_ghosts,
    ghost_vendors,
    row_accounting,
    split_ghosts,
)
from tripaudit.operators.impute import (
    ImputePlan,
    exact_sample,
    fallback_plan,
    impute_counts,
    impute_month,
    imputed_rows,
    plan_imputation,
    poisson_sample,
)
from tripaudit.operators.partials import (
    merge_states,
    merged_accounting,
    merged_daily,
    merged_reports,
    partial_states,
)
from tripaudit.operators.reshape import tip_series, velocity_pivot
from tripaudit.operators.weather import rain_elasticity, rain_join, rain_trend
from tripaudit.operators.zone import (
    audit_leakage,
    mark_zone,
    mark_zone_table,
    surcharge_compliance,
    zone_ids,
)

__all__ = [
    "GhostSplit",
    "ImputePlan",
    "audit_leakage",
    "border_effect",
    "daily_trips",
    "derive_metrics",
    "exact_sample",
    "fallback_plan",
    "filter_ghost_trips",
    "flag_ghosts",
    "ghost_vendors",
    "impute_counts",
    "impute_month",
    "imputed_rows",
    "mark_zone",
    "mark_zone_table",
    "merge_states",
    "merged_accounting",
    "merged_daily",
    "merged_reports",
    "partial_states",
    "period_summary",
    "plan_imputation",
    "poisson_sample",
    "q1_comparison",
    "rain_elasticity",
    "rain_join",
    "rain_trend",
    "row_accounting",
    "split_ghosts",
    "surcharge_compliance",
    "tip_series",
    "tip_vs_surcharge",
    "velocity_heatmap",
    "velocity_pivot",
    "volume_by_quarter",
    "volume_by_year",
    "zone_ids",
]

"""Run parameters for the trip audit.

Every threshold that drives a predicate lives here, so operators take one
``AuditConfig`` instead of reading module constants.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Drop-off location ids treated as the priced (congestion) zone.
# They must stay exactly this list for results to agree with the audited
# pipeline; 60 ids, ascending.
ZONE_IDS: tuple[int, ...] = (
    4, 12, 13, 24, 43, 45, 48, 50, 68, 79, 87, 88, 90, 100, 107, 113, 114, 116,
    120, 125, 127, 128, 137, 140, 141, 142, 143, 144, 148, 151, 152, 153, 158,
    161, 162, 163, 164, 166, 170, 186, 209, 211, 224, 229, 230, 231, 232, 233,
    234, 236, 237, 238, 239, 243, 244, 246, 249, 261, 262, 263,
)

# The two fleets of the trip-record feed.
FLEET_NAMES: tuple[str, ...] = ("yellow", "green")


@dataclass(frozen=True)
class AuditConfig:
    """Thresholds and calendar settings of one audit run.

    Ghost rules (a trip is implausible when any holds):
      A  speed_mph > speed_limit_mph
      B  duration_seconds < min_trip_seconds AND fare > short_trip_fare
      C  trip_distance = 0 AND fare > 0
    """

    speed_limit_mph: float = 65.0
    min_trip_seconds: int = 60
    short_trip_fare: float = 20.0
    # Below this many hours the speed is reported as 0 instead of dividing.
    min_hours_for_speed: float = 0.001
    zone_ids: tuple[int, ...] = ZONE_IDS

    # Missing-month imputation: target month, the two history months one and
    # two years earlier, and their weights (older, newer).
    impute_year: int = 2025
    impute_month: int = 12
    history_weights: tuple[float, float] = (0.3, 0.7)
    # A target month with more rows than this counts as present.  The rule decides whether
    # a month is imputed at all, so the run reports the action taken.
    present_threshold: int = 1000
    impute_seed: int = 2025

    # Days of one year joined to demand (None: every landed day).
    weather_year: int | None = None

    top_leakage: int = 3
    top_vendors: int = 5
    # Registered names, or FleetSpec objects.
    fleets: tuple = field(default=FLEET_NAMES)

    def with_(self, **changes) -> "AuditConfig":
        from dataclasses import replace

        return replace(self, **changes)


DEFAULT = AuditConfig()

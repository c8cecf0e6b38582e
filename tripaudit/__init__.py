"""Trip audit analytics as Spark DataFrame jobs.

Layout: ``sources`` (intake and sinks), ``functions`` (Column building
blocks), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (the full
audit run and the registered query suite), ``streaming`` (incremental
intake with Structured Streaming).
"""

from tripaudit.config import DEFAULT, ZONE_IDS, AuditConfig
from tripaudit.schema import (
    GREEN,
    UNIFIED_COLUMNS,
    UNIFIED_SCHEMA,
    YELLOW,
    FleetSpec,
    fleet,
    register_fleet,
    unify_schema,
)

__all__ = [
    "DEFAULT",
    "GREEN",
    "UNIFIED_COLUMNS",
    "UNIFIED_SCHEMA",
    "YELLOW",
    "ZONE_IDS",
    "AuditConfig",
    "FleetSpec",
    "fleet",
    "register_fleet",
    "unify_schema",
]

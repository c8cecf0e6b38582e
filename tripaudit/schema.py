"""Unified trip schema and the fleet registry.

A fleet is described by a :class:`FleetSpec`: how its monthly files are
named and which source column feeds each unified column.  ``unify_schema``
turns any frame of that fleet into the fixed unified layout with one
``select`` (rename + cast + typed NULL for what is absent), so Catalyst
prunes every unused source column out of the Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unified trip layout, in declared order.
UNIFIED_FIELDS: tuple[tuple[str, T.DataType], ...] = (
    ("pickup_time", T.TimestampNTZType()),
    ("dropoff_time", T.TimestampNTZType()),
    ("pickup_loc", T.IntegerType()),
    ("dropoff_loc", T.IntegerType()),
    ("trip_distance", T.DoubleType()),
    ("fare", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("vendor_id", T.IntegerType()),
    ("taxi_type", T.StringType()),
)
UNIFIED_COLUMNS: tuple[str, ...] = tuple(n for n, _ in UNIFIED_FIELDS)
UNIFIED_TYPES: dict[str, T.DataType] = dict(UNIFIED_FIELDS)
UNIFIED_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in UNIFIED_FIELDS])

def _widened(t: T.DataType) -> T.DataType:
    """Type used to *read* a source column: integers widen to LONG so files
    that stored an id as INT32 in one month and INT64 in another read with
    one schema; the unify step casts down to the declared type."""
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return t


@dataclass(frozen=True)
class FleetSpec:
    """Source description of one fleet.

    ``columns`` maps unified column -> source column.  Unified columns not
    mapped (or mapped but absent from a frame) become typed NULLs.
    ``file_glob`` selects the fleet's files inside a raw directory.
    ``folder`` is the part of the raw directory that holds them (may be a
    glob).  ``timestamp_type`` is the Parquet read type of timestamp columns.
    """

    name: str
    columns: dict[str, str]
    file_glob: str = ""
    folder: str = ""
    timestamp_type: T.DataType = field(default_factory=T.TimestampNTZType)

    def glob(self) -> str:
        return self.file_glob or f"*{self.name}_tripdata*.parquet"

    def read_schema(self) -> T.StructType:
        """Explicit, widened read schema holding only mapped source columns."""
        out = []
        for target, source in self.columns.items():
            t = UNIFIED_TYPES[target]
            if isinstance(t, T.TimestampNTZType):
                t = self.timestamp_type
            out.append(T.StructField(source, _widened(t), True))
        return T.StructType(out)


# Source column names of the public trip-record files.
YELLOW = FleetSpec(
    "yellow",
    {
        "pickup_time": "tpep_pickup_datetime",
        "dropoff_time": "tpep_dropoff_datetime",
        "pickup_loc": "PULocationID",
        "dropoff_loc": "DOLocationID",
        "trip_distance": "trip_distance",
        "fare": "fare_amount",
        "total_amount": "total_amount",
        "congestion_surcharge": "congestion_surcharge",
        "tip_amount": "tip_amount",
        "vendor_id": "VendorID",
    },
)
GREEN = FleetSpec(
    "green",
    {
        "pickup_time": "lpep_pickup_datetime",
        "dropoff_time": "lpep_dropoff_datetime",
        "pickup_loc": "PULocationID",
        "dropoff_loc": "DOLocationID",
        "trip_distance": "trip_distance",
        "fare": "fare_amount",
        "total_amount": "total_amount",
        "congestion_surcharge": "congestion_surcharge",
        "tip_amount": "tip_amount",
        "vendor_id": "VendorID",
    },
)

_REGISTRY: dict[str, FleetSpec] = {YELLOW.name: YELLOW, GREEN.name: GREEN}


def register_fleet(spec: FleetSpec) -> FleetSpec:
    """Add (or replace) a fleet description; returns it for chaining."""
    _REGISTRY[spec.name.lower()] = spec
    return spec


def fleet(name: str | FleetSpec) -> FleetSpec:
    """Look a fleet up by case-insensitive name; unknown names raise."""
    if isinstance(name, FleetSpec):
        return name
    spec = _REGISTRY.get(str(name).lower())
    if spec is None:
        raise ValueError(f"no fleet is registered as {name!r}; known: {sorted(_REGISTRY)}")
    return spec


def typed_null(name: str) -> Column:
    return F.lit(None).cast(UNIFIED_TYPES[name]).alias(name)


def unify_schema(df: DataFrame, taxi_type: str | FleetSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project a fleet frame onto the unified layout (PRJ-1..5); ``keep`` names columns to
    carry along.

    Source names are matched case-insensitively, like Spark's resolver.
    Absent sources become typed NULLs, extra source columns are dropped,
    and the fleet name is attached as ``taxi_type``.  The result always has
    ``UNIFIED_COLUMNS`` in declared order and declared types, which makes
    the function idempotent on its own output (mapped names resolve to the
    unified names once a frame has been unified).
    """
    spec = fleet(taxi_type)
    types = {f.name: f.dataType for f in df.schema.fields}
    present = {c.lower(): c for c in types}
    cols: list[Column] = []
    for name in UNIFIED_COLUMNS:
        if name == "taxi_type":
            cols.append(F.lit(spec.name).alias("taxi_type"))
            continue
        source = spec.columns.get(name)
        hit = present.get(source.lower()) if source else None
        if hit is None:
            hit = present.get(name)  # already unified
        if hit is None:
            cols.append(typed_null(name))
        else:
            cols.append(_typed(hit, types[hit], name))
    return df.select(*cols, *keep)


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def narrow(c: Column, target: T.DataType, current: T.DataType | None = None) -> Column:
    """Cast to ``target``; a value that does not fit becomes NULL instead of failing the whole
    job under ANSI mode.  A fraction has no place among ids: 7.0 is 7, 7.5 is NULL."""
    if isinstance(target, _INTEGRAL) and isinstance(current, _FRACTIONAL):
        return F.when(F.rint(c.cast("double")) == c, c.try_cast(target))
    if isinstance(target, _INTEGRAL) or isinstance(current, T.StringType):
        return c.try_cast(target)
    return c.cast(target)


def ids_lost(df: DataFrame, spec: FleetSpec) -> Column:
    """Aggregate: source values of a fleet frame that do not fit their unified type and become
    NULL in ``unify_schema`` (ids too large or with a fraction, texts that are no number)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    present = {c.lower(): c for c in types}
    lost = F.lit(0)
    for target, source in spec.columns.items():
        hit = present.get(source.lower())
        if hit is None:
            continue
        if isinstance(UNIFIED_TYPES[target], _INTEGRAL) or isinstance(types[hit], T.StringType):
            c = F.col(f"`{hit}`")
            lost = lost + F.when(c.isNotNull() & narrow(c, UNIFIED_TYPES[target], types[hit]).isNull(), 1).otherwise(0)
    return F.coalesce(F.sum(lost), F.lit(0)).cast("bigint")


def _typed(source: str, current: T.DataType, name: str) -> Column:
    """``source`` as unified column ``name``, cast only when needed."""
    c = F.col(f"`{source}`")
    if current != UNIFIED_TYPES[name]:
        c = narrow(c, UNIFIED_TYPES[name], current)
    return c.alias(name) if source != name else c


def conform(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Select the unified columns (typed NULL where absent) plus ``extra``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [_typed(n, types[n], n) if n in types else typed_null(n) for n, _ in UNIFIED_FIELDS]
    return df.select(*cols, *extra)

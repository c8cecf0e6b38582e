"""Multi-file Parquet intake of fleet trip files (SRC-1..5, SET-1)."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tripaudit.schema import FleetSpec, fleet, unify_schema

log = logging.getLogger(__name__)


def read_fleet(spark: SparkSession, raw_dir: str | list[str], spec: str | FleetSpec,
               ignore_corrupt_files: bool = False) -> DataFrame:
    """Scan every file of one fleet as one frame, with the fleet's explicit
    widened schema.  Files missing a mapped column read it as NULL, extra
    columns are never read, INT/BIGINT drift between months is absorbed.

    ``raw_dir`` is a directory (the fleet's files are picked by its name
    pattern; listing is Spark's, on any Hadoop filesystem) or an explicit
    list of file paths read as one frame.  ``ignore_corrupt_files`` skips
    unreadable files (Spark's file-source option) instead of failing; it is
    off by default so no data is dropped silently."""
    spec = fleet(spec)
    reader = spark.read.schema(spec.read_schema())
    if spec.folder and not isinstance(raw_dir, (list, tuple)):
        raw_dir = f"{raw_dir.rstrip('/')}/{spec.folder}"
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    if isinstance(raw_dir, (list, tuple)):
        return reader.parquet(*raw_dir)
    return reader.option("pathGlobFilter", spec.glob()).parquet(raw_dir)


def union_fleets(frames: Iterable[DataFrame]) -> DataFrame | None:
    """Bag union by column name; columns missing on one side become NULL."""
    frames = list(frames)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_trips(spark: SparkSession, raw_dir: str,
               fleets: Iterable[str | FleetSpec] = ("yellow", "green"),
               ignore_corrupt_files: bool = False) -> DataFrame | None:
    """Read, unify and union all fleets found in ``raw_dir`` (FLW-2).

    A missing directory gives None.  A fleet without files or rows adds no
    rows to the union; nothing is probed beforehand.  Any other failure is
    raised, here or when the frame is read: no fleet is ever left out
    silently (``stage_audit`` has an opt-in that leaves failing fleets out
    and lists them; ``ignore_corrupt_files`` skips unreadable files only).
    Unknown fleet names raise ValueError before any I/O."""
    specs = [fleet(f) for f in fleets]
    try:
        frames = [unify_schema(read_fleet(spark, raw_dir, s, ignore_corrupt_files), s) for s in specs]
    except AnalysisException as exc:
        if path_missing(exc):
            log.warning("raw directory does not exist: %s", raw_dir)
            return None
        raise
    return union_fleets(frames)


def path_missing(exc: AnalysisException) -> bool:
    return exc.getCondition() == "PATH_NOT_FOUND"


def source_counts(trips: DataFrame) -> DataFrame:
    """Rows per fleet in one aggregate pass (SRC-4)."""
    return trips.groupBy("taxi_type").agg(F.count(F.lit(1)).alias("count"))


def count_history_files(spark: SparkSession, raw_dir: str, year: int, month: int) -> int:
    """Raw row count of every fleet's file for one month (SRC-5 fallback), answered from
    footers; 0 only when there is no such file or directory.  Other errors are raised, as
    a wrong 0 would change the size of the imputed month."""
    reader = spark.read.option("pathGlobFilter", f"*tripdata_{year}-{month:02d}.parquet").schema("_none int")
    try:
        return reader.parquet(raw_dir).count()
    except AnalysisException as exc:
        if path_missing(exc):
            return 0
        raise

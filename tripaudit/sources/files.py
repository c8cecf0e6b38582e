"""Parquet / CSV sinks and the CSV read-back (SNK-1/2, SRC-6)."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

log = logging.getLogger(__name__)


def rebalanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out for writing: under AQE every task gets about the advisory partition size
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), rows of one key stay together while
    they are fewer than that, and a larger key is split over several tasks."""
    return df.hint("rebalance", *keys)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: tuple[str, ...] = (), sized: bool = False) -> str:
    """Snappy Parquet, one file per task of the plan's last stage.  With ``sized`` the rows are
    rebalanced first, so that the number of files follows the bytes written and not the
    number of input splits; that shuffles the rows, and is meant for selective frames such as
    the audited trips."""
    w = (rebalanced(df, *partition_by) if sized else df).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              single_file: bool = False) -> str:
    """Header CSV.  ``single_file`` coalesces to one part file and is meant
    for the small aggregate reports (bounded by their group keys).  Columns
    must be typed (no VOID)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a header CSV back with an explicit schema (StructType or DDL
    string; no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


class Reports(NamedTuple):
    """Frames by report name, and what could not be read with the reason."""

    frames: dict[str, DataFrame]
    failed: dict[str, str]


def _header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a header CSV (no column is typed, one line is read)."""
    return spark.read.option("header", True).csv(path).columns


def read_reports(spark: SparkSession, paths: Mapping[str, str], schemas: Mapping[str, T.StructType | str],
                 skip_failed: bool = False) -> Reports:
    """Load several report CSVs (SRC-6).  A report that is missing, or whose header is not its
    declared layout, raises; with ``skip_failed`` it is left out and listed in ``failed``."""
    frames: dict[str, DataFrame] = {}
    failed: dict[str, str] = {}
    for name, path in paths.items():
        try:
            frame = read_csv(spark, path, schemas[name])
            if (header := _header_of(spark, path)) and header != frame.columns:
                raise ValueError(f"report {name} has the columns {header}, not {frame.columns}")
            frames[name] = frame
        except (AnalysisException, ValueError) as exc:
            if not skip_failed:
                raise
            log.warning("report %s not loaded: %s", name, exc)
            failed[name] = str(exc)
    return Reports(frames, failed)

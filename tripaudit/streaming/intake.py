"""Incremental intake (SRC-10 in streaming form).

The Parquet file source remembers, in its checkpoint, which files it has
already taken in, so each run processes only files that landed since the
last one: the "skip files already present" rule of a downloader.  Rows are
unified, flagged and zone-marked with the same Column expressions as the batch
path and appended to one Parquet folder per fleet.  Each folder has its sink's
commit log, and exactly-once holds for readers that go by it: read the
folders with ``read_intake``; a plain read of the parent folder would also see
files of a batch that has not been committed.

The intake also keeps the row counts of the files it saw, by name (``record_history``).  They
answer for a history month whose trips are not found by pick-up time, also when its raw file
is long gone, so an audit that starts from the intake sizes an imputed month like one that
starts from the files.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripaudit.config import DEFAULT, AuditConfig
from tripaudit.functions.trips import ghost_flag
from tripaudit.operators.ghost import derive_metrics
from tripaudit.operators.zone import mark_zone
from tripaudit.schema import FleetSpec, fleet, unify_schema
from tripaudit.session import ensure_checkpoint_dir, list_names, read_text, write_text
from tripaudit.sources.footers import check_files
from tripaudit.sources.trips import union_fleets

#: The intake's row counts by file name; the underscore hides it from scans.
HISTORY = "_history.json"


def flagged_stream(spark: SparkSession, raw_dir: str, spec: str | FleetSpec,
                   cfg: AuditConfig = DEFAULT, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of one fleet's new files, unified and flagged."""
    spec = fleet(spec)
    reader = (spark.readStream.schema(spec.read_schema())
              .option("pathGlobFilter", spec.glob()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    raw = reader.parquet(raw_dir)
    out = derive_metrics(unify_schema(raw, spec), cfg).withColumn("is_ghost", ghost_flag(cfg))
    g = F.col("is_ghost")
    # Per micro-batch row accounting, reported in the query progress
    # (``lastProgress["observedMetrics"]["accounting"]``) at no extra pass.
    out = out.observe("accounting", F.count(F.lit(1)).alias("total"),
                      F.count(F.when(~g, 1)).alias("clean"), F.count(F.when(g, 1)).alias("audit"),
                      F.count(F.when(g.isNull(), 1)).alias("undetermined"))
    return (mark_zone(out, cfg.zone_ids)
            .withColumn("status", F.when(g, F.lit("audit")).when(~g, F.lit("clean"))
                        .otherwise(F.lit("undetermined")))
            .withColumn("year", F.year("pickup_time"))
            .withColumn("month", F.month("pickup_time")))


def record_history(spark: SparkSession, raw_dir: str, out_path: str, fleets=("yellow", "green")) -> dict[str, int]:
    """Add the row counts of all landed files, from their footers, to those the intake has; a
    file that landed again counts as it is now."""
    counts = read_history(spark, out_path)
    for f in fleets:
        counts |= {x.path.rsplit("/", 1)[-1]: x.rows for x in check_files(spark, raw_dir, f) if x.error is None}
    write_text(spark, f"{out_path}/{HISTORY}", json.dumps(counts, sort_keys=True))
    return counts


def read_history(spark: SparkSession, out_path: str) -> dict[str, int]:
    """Row counts by file name that an intake has kept; empty before its first run."""
    return json.loads(read_text(spark, f"{out_path}/{HISTORY}")) if HISTORY in list_names(spark, out_path) else {}


def start_intake(spark: SparkSession, raw_dir: str, out_path: str,
                 fleets=("yellow", "green"), cfg: AuditConfig = DEFAULT,
                 checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Start one append query per fleet into ``out_path`` (partitioned by
    status, year, month, like the staged table of the batch run).  Checkpoints live under the cluster's shared checkpoint
    folder unless given.  ``available_now`` drains what has landed and
    stops, which suits a scheduled job."""
    root = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tripaudit-intake"
    record_history(spark, raw_dir, out_path, fleets)
    queries = []
    for f in fleets:
        spec = fleet(f)
        w = (flagged_stream(spark, raw_dir, spec, cfg, max_files_per_trigger)
             .writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{root}/{spec.name}")
             .partitionBy("status", "year", "month"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        queries.append(w.start(f"{out_path}/taxi_type={spec.name}"))
    return queries


def read_intake(spark: SparkSession, out_path: str, fleets=("yellow", "green")) -> DataFrame:
    """Committed rows of all fleets taken in under ``out_path``; each fleet's folder is read
    by itself, so that its sink's commit log decides which files count."""
    from tripaudit.plans.audit_run import STAGED_SCHEMA

    fields = [f for f in STAGED_SCHEMA.fields if f.name != "is_imputed"]
    frames = []
    for f in fleets:
        spec = fleet(f)
        df = spark.read.parquet(f"{out_path}/taxi_type={spec.name}").withColumn("taxi_type", F.lit(spec.name))
        frames.append(df.select(*[F.col(x.name).cast(x.dataType) for x in fields]))
    return union_fleets(frames)

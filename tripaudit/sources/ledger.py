"""Intake that sees changed files (SRC-10, JN-2): a ledger of landed files and an upsert of
what they replace.

A landed file is known by its name; a later landing of the same name, under the same path or
in another folder, replaces it.  The ledger holds, per name, the path, size and time of the
latest landing, its rows, and a digest of its content: the sum of the hashes of its rows, so a
file that was only touched, or written again in another order or compression, is the same.

Taken-in trips are partitioned by the name they landed under.  Taking files in overwrites just
their partitions (dynamic partition overwrite), trips before ledger, so a run that is repeated
after a failure, or a micro-batch that is tried again, leaves the same rows.  ``take_in`` is
the batch form: it lists all landed files and reads those whose size, time or path the ledger
does not know.  ``upsert_stream`` is the streaming one; as Spark's file source knows files by
path, it sees a month that lands again in a folder of its own.  Both come to the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripaudit.schema import FleetSpec, fleet, unify_schema
from tripaudit.session import ensure_checkpoint_dir, list_names, open_files

LEDGER = "path string, size bigint, modified timestamp, rows bigint, content decimal(38,0), name string"
#: Where the taken-in trips and the ledger lie under an intake folder.
TRIPS, FILES = "trips", "ledger"
#: A file scan's source columns.
SOURCE = {"name": "file_name", "path": "file_path", "size": "file_size", "modified": "file_modification_time"}


def with_source(raw: DataFrame) -> DataFrame:
    """Rows of a file scan with the file that each came from, as ``_file``."""
    return raw.select("*", F.struct(*[F.col(f"_metadata.{m}").alias(n) for n, m in SOURCE.items()]).alias("_file"))


def _latest() -> Column:
    return F.struct("modified", "path")


def file_ledger(raw: DataFrame) -> DataFrame:
    """The ledger of a scan ``with_source`` that holds one landing per name.  A digest is a
    sum of row hashes, so it needs no order and the parts of a split file add up."""
    data = [c for c in raw.columns if c != "_file"]
    return (raw.groupBy("_file").agg(F.count(F.lit(1)).alias("rows"),
                                     F.sum(F.xxhash64(*data).cast("decimal(38,0)")).alias("content"))
            .select("_file.path", "_file.size", "_file.modified", "rows", "content", "_file.name"))


def compare_ledgers(old: DataFrame, new: DataFrame) -> DataFrame:
    """What became of every file name: ``new``, ``changed`` (other rows), ``same`` (also when
    it was touched or moved) or ``gone``."""
    a = old.select("name", F.struct("rows", "content").alias("_a"))
    b = new.select("name", F.struct("rows", "content").alias("_b"))
    state = (F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "gone")
             .when(F.col("_a") == F.col("_b"), "same").otherwise("changed"))
    return a.join(b, "name", "full").select("name", state.alias("state"))


def latest_files(files: DataFrame, known: DataFrame) -> DataFrame:
    """Of listed files (name, path, size, modified), the latest landing of every name, unless
    the ledger ``known`` holds that landing or a later one."""
    last = files.groupBy("name").agg(F.max_by(F.struct("path", "size", "modified"), _latest()).alias("f")).select("name", "f.*")
    held = known.select("name", F.struct("path", "size", "modified").alias("_held"))
    here = F.struct("path", "size", "modified")
    return (last.join(held, "name", "left")
            .filter(F.col("_held").isNull() | (here != F.col("_held")) & (F.col("modified") >= F.col("_held.modified")))
            .select("name", "path", "size", "modified"))


def read_ledger(spark: SparkSession, out: str) -> DataFrame:
    """The ledger of an intake folder; empty before the first run."""
    path = f"{out}/{FILES}"
    return spark.read.schema(LEDGER).parquet(path) if list_names(spark, path) else spark.createDataFrame([], LEDGER)


def read_taken(spark: SparkSession, out: str) -> DataFrame:
    """The taken-in trips of an intake folder, with ``landed``, the name they came under."""
    return spark.read.parquet(f"{out}/{TRIPS}")


def _upsert(rows: DataFrame, path: str, key: str) -> None:
    """Replace the partitions that ``rows`` has, and no others.  A scan's tasks have few names."""
    with open_files(rows.sparkSession):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def _take(raw: DataFrame, spec: FleetSpec, out: str) -> None:
    """Take in a scan ``with_source`` that holds one landing per name: trips, then ledger."""
    spark = raw.sparkSession
    ledger = file_ledger(raw)
    states = compare_ledgers(read_ledger(spark, out), ledger)
    # One small row per landed file; a moved or touched file only gets its ledger row anew.
    fresh = [r["name"] for r in states.filter(F.col("state").isin("new", "changed")).select("name").collect()]
    if fresh:
        named = raw.filter(F.col("_file.name").isin(fresh)).withColumn("landed", F.col("_file.name"))
        _upsert(unify_schema(named, spec, keep=("landed",)), f"{out}/{TRIPS}", "landed")
    _upsert(ledger, f"{out}/{FILES}", "name")


def take_in(spark: SparkSession, raw_dir: str, out: str, spec: str | FleetSpec) -> int:
    """Take in the files of ``raw_dir`` (folders in it included) that the ledger of ``out``
    does not know as they are; returns how many were read."""
    spec = fleet(spec)
    m = F.col("modificationTime")
    listed = (spark.read.format("binaryFile").option("pathGlobFilter", spec.glob())
              .option("recursiveFileLookup", "true").load(raw_dir)
              .select(F.substring_index("path", "/", -1).alias("name"), "path", F.col("length").alias("size"),
                      m.alias("modified")))
    # The ledger has paths as scans report them.
    known = read_ledger(spark, out).withColumn("path", F.regexp_replace(F.url_decode("path"), r"^(\w+):/+", "$1:/"))
    todo = [r["path"] for r in latest_files(listed, known).select("path").collect()]  # files landed since
    if todo:
        _take(with_source(spark.read.schema(spec.read_schema()).parquet(*todo)), spec, out)
    return len(todo)


def upsert_stream(spark: SparkSession, raw_dir: str, out: str, spec: str | FleetSpec,
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that takes in what lands below ``raw_dir`` and stops when it has caught
    up.  Every micro-batch is an upsert, so trying one again changes nothing."""
    spec = fleet(spec)
    reader = (spark.readStream.schema(spec.read_schema()).option("pathGlobFilter", spec.glob())
              .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))

    def upsert(batch: DataFrame, _: int) -> None:
        files = batch.select("_file.*").distinct()
        # One small row per landed file: rows stay where they are read, not one task per file.
        last = F.broadcast(latest_files(files, read_ledger(spark, out)).select(F.col("path").alias("_path")))
        _take(batch.join(last, batch["_file"]["path"] == last["_path"], "left_semi"), spec, out)

    root = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/tripaudit-upsert/{spec.name}"
    return (with_source(reader.parquet(raw_dir)).writeStream.foreachBatch(upsert)
            .option("checkpointLocation", root).trigger(availableNow=True).start())

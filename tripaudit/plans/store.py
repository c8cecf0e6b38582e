"""A staged trip table made of batches, with a manifest (FLW-4).

A batch is a set of input files staged together: its flagged trips, its partial aggregates
and, written last, its manifest record with the files it came from and what its write counted.
Only batches with a record exist for readers.  Whatever a run that was stopped, or a task
committer that moves files early, left behind has no record, is never read and is cleared by
the next run.  A batch's name is a digest of its files (path, size, time), its settings and
its read schema, so a rerun finds what is staged already, skips those files without opening
them, and takes a file that changed for a new one.

    root/trips/batch=<name>/status=../year=../month=../*.parquet
    root/partials/batch=<name>/*.parquet
    root/manifest/<name>.json

One run at a time may write to a store.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.operators.partials import SCHEMA as PARTIAL_SCHEMA
from tripaudit.operators.partials import merge_states
from tripaudit.schema import UNIFIED_SCHEMA
from tripaudit.session import delete_path, list_names, read_text, write_text
from tripaudit.sources.files import rebalanced

#: Explicit schema of the staged table: reading it takes no inference pass.
STAGED_SCHEMA = T.StructType([
    *UNIFIED_SCHEMA.fields,
    T.StructField("duration_seconds", T.LongType()), T.StructField("duration_hours", T.DoubleType()),
    T.StructField("speed_mph", T.DoubleType()), T.StructField("is_ghost", T.BooleanType()),
    T.StructField("inside_zone", T.BooleanType()), T.StructField("is_imputed", T.BooleanType()),
    T.StructField("status", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])
LAYOUT = ("status", "year", "month")


@dataclass
class Batch:
    """One manifest record.  ``replaces`` names the batches that it took the place of."""

    name: str
    fleet: str
    settings: str
    files: list[list] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    replaces: list[str] = field(default_factory=list)


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:24]


class TripStore:
    """Batches under one folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    @property
    def trips_path(self) -> str:
        return f"{self.root}/trips"

    def trips(self, name: str) -> str:
        return f"{self.trips_path}/batch={name}"

    def partials(self, name: str) -> str:
        return f"{self.root}/partials/batch={name}"

    def record(self, name: str) -> str:
        return f"{self.root}/manifest/{name}.json"

    def committed(self) -> dict[str, Batch]:
        """All batches with a record that no other record replaces."""
        found = [n for n in list_names(self.spark, f"{self.root}/manifest") if n.endswith(".json")]
        batches = [Batch(**json.loads(read_text(self.spark, f"{self.root}/manifest/{n}"))) for n in found]
        gone = {n for b in batches for n in b.replaces}
        return {b.name: b for b in batches if b.name not in gone}

    def clear_leftovers(self) -> list[str]:
        """Delete what has no record: leftovers of stopped runs and replaced batches."""
        live = self.committed()
        left = set()
        for folder in (self.trips_path, f"{self.root}/partials"):
            for n in list_names(self.spark, folder):
                if n.startswith("batch=") and n.removeprefix("batch=") not in live:
                    delete_path(self.spark, f"{folder}/{n}")
                    left.add(n.removeprefix("batch="))
        for n in list_names(self.spark, f"{self.root}/manifest"):
            if n.removesuffix(".json") not in live:
                delete_path(self.spark, f"{self.root}/manifest/{n}")
        return sorted(left)

    def drop(self, name: str) -> None:
        """Forget a batch: its record first, so that no reader meets half of it."""
        for path in (self.record(name), self.partials(name), self.trips(name)):
            delete_path(self.spark, path)

    def commit(self, batch: Batch) -> Batch:
        write_text(self.spark, self.record(batch.name), json.dumps(asdict(batch)))
        return batch

    def read_trips(self, names: Iterable[str]) -> DataFrame:
        """The trips of some batches as one pruned scan."""
        paths = [self.trips(n) for n in names]
        reader = self.spark.read.schema(STAGED_SCHEMA).option("basePath", self.trips_path)
        return (reader.parquet(*paths) if paths else self.spark.createDataFrame([], STAGED_SCHEMA)).select(
            *STAGED_SCHEMA.fieldNames())

    def read_partials(self, names: Iterable[str]) -> DataFrame:
        """The partials of some batches, one row per key and batch: reports add them up."""
        paths = [self.partials(n) for n in names]
        return self.spark.read.schema(PARTIAL_SCHEMA).parquet(*paths) if paths else \
            self.spark.createDataFrame([], PARTIAL_SCHEMA)

    def compact(self) -> list[Batch]:
        """Rewrite the batches of every fleet as one, with files of the size that AQE aims at:
        rows are rebalanced by status and month, small months share a task, a large one is
        split.  Partials are added up, not counted again.  The new record replaces the old
        ones at once; a run that stops before it leaves them as they were."""
        live = self.committed()
        groups: dict[tuple, list[Batch]] = {}
        for b in live.values():
            groups.setdefault((b.fleet, b.settings), []).append(b)
        made = []
        for (fleet, settings), old in sorted(groups.items()):
            if len(old) < 2:
                continue
            names = sorted(b.name for b in old)
            new = Batch(digest("compact", names), fleet, settings, sorted(f for b in old for f in b.files),
                        dict(sum((Counter(b.counts) for b in old), Counter())), names)
            rebalanced(self.read_trips(names), *LAYOUT).write.mode("overwrite").partitionBy(*LAYOUT) \
                .parquet(self.trips(new.name))
            merge_states(self.read_partials(names)).write.mode("overwrite").parquet(self.partials(new.name))
            made.append(self.commit(new))
        self.clear_leftovers()
        return made

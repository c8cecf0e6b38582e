"""What the footers of landed files say before anything is scanned (SRC-1, SRC-3).

``check_files`` lists a fleet's files and reads every footer: row count, physical type of the
columns that the fleet uses, or why the footer cannot be read.  ``plan_files`` turns that into
groups of files that can be read with one schema, and a quarantine: files that are no Parquet
files, or that hold a column in a type nothing can be made of.  One Spark scan per group then
reads the good files only, so a single bad file costs neither its fleet nor the run.

Ids that are INT in one month, BIGINT in the next and DOUBLE in a third are two groups: whole
numbers of any width are read as BIGINT, fractions as DOUBLE.  ``unify_schema`` casts both to
the declared type; what does not fit becomes NULL and is counted.

Footers are read through Hadoop's file system on threads of the driver, a few kilobytes a
file, next to the listing that any Spark scan does there; no rows pass.  A footer says nothing
about the pages behind it: ``damaged_files`` reads the columns of a failing group in one
distributed job and compares the rows of every file with its footer.
"""

from __future__ import annotations

import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from tripaudit.schema import UNIFIED_TYPES, FleetSpec, fleet

FOOTER_THREADS = 16
#: A top-level column in the text of a Parquet schema: repetition, physical type, name, annotation.
_COLUMN = re.compile(r"^  (optional|required|repeated) (\S+) (.+?)(?: \((.*)\))?(?: = \d+)?(?:;| \{)$")
FACTS = "fleet string, path string, size bigint, modified bigint, rows bigint, types map<string,string>, error string"


@dataclass(frozen=True)
class FileFacts:
    """One landed file.  ``types`` maps lower-cased column names to physical types."""

    path: str
    size: int
    modified: int
    rows: int | None = None
    types: dict[str, str] = field(default_factory=dict)
    error: str | None = None

    @property
    def key(self) -> tuple[str, int, int]:
        """What tells one state of a file from another."""
        return self.path, self.size, self.modified


@dataclass
class FilePlan:
    """Files of one fleet by read schema, and those left out with the reason."""

    spec: FleetSpec
    groups: list[tuple[T.StructType, list[FileFacts]]]
    quarantined: dict[str, str]


def list_files(spark: SparkSession, raw_dir: str | list[str], spec: str | FleetSpec) -> list[FileFacts]:
    """The files of one fleet, as Spark lists them on any file system; a missing directory
    raises like a read of it."""
    spec = fleet(spec)
    if isinstance(raw_dir, str):
        raw_dir = [f"{raw_dir.rstrip('/')}/{spec.folder}" if spec.folder else raw_dir]
    listed = spark.read.format("binaryFile").option("pathGlobFilter", spec.glob()).load(raw_dir)
    found = listed.select("path", "length", F.unix_millis("modificationTime").alias("modified")).collect()
    files = [FileFacts(r["path"], r["length"], r["modified"]) for r in found]
    # A scan passes over files without a byte, which are downloads that failed.
    seen = {_plain(f.path) for f in files}
    reported = [_plain(unquote(p)) for p in listed.inputFiles()]
    files += [FileFacts(p, 0, 0, error="the file is empty") for p in reported if p not in seen]
    return sorted(files, key=lambda f: f.path)


def parquet_types(schema: str) -> dict[str, str]:
    """Physical types by lower-cased column name, from the text of a Parquet schema."""
    out = {}
    for line in schema.splitlines():
        if m := _COLUMN.match(line):
            repetition, physical, name, note = m.groups()
            kind = "group" if physical == "group" or repetition == "repeated" else physical
            out[name.lower()] = f"{kind} ({note})" if note else kind
    return out


def _read_footer(spark: SparkSession, facts: FileFacts, wanted: set[str]) -> FileFacts:
    if facts.error:
        return facts
    jvm = spark.sparkContext._jvm
    try:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
            jvm.org.apache.hadoop.fs.Path(facts.path), spark.sparkContext._jsc.hadoopConfiguration())
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            rows = reader.getRecordCount()
            types = parquet_types(reader.getFooter().getFileMetaData().getSchema().toString())
        finally:
            reader.close()
    except Py4JJavaError as exc:
        reason = str(exc.java_exception.toString()).splitlines()[0]
        return FileFacts(facts.path, facts.size, facts.modified, error=reason)
    return FileFacts(facts.path, facts.size, facts.modified, rows, {c: t for c, t in types.items() if c in wanted})


def check_files(spark: SparkSession, raw_dir: str | list[str], spec: str | FleetSpec,
                threads: int = FOOTER_THREADS) -> list[FileFacts]:
    """List a fleet's files and read their footers, many at a time."""
    spec = fleet(spec)
    files = list_files(spark, raw_dir, spec)
    wanted = {c.lower() for c in spec.columns.values()}
    read = inheritable_thread_target(spark)(lambda f: _read_footer(spark, f, wanted))
    with ThreadPoolExecutor(max_workers=threads) as pool:
        return list(pool.map(read, files))


def read_type(physical: str, target: T.DataType, timestamp_type: T.DataType) -> T.DataType | None:
    """Type with which to read a column for a unified ``target``; None when there is no way."""
    kind, _, note = physical.rstrip(")").partition(" (")
    if kind in ("int32", "int64") and (not note or note.startswith("INTEGER(")):
        number = T.DecimalType(20, 0) if note == "INTEGER(64,false" else T.LongType()
    elif m := re.match(r"DECIMAL\((\d+),\s*(\d+)", note):
        number = T.DecimalType(int(m[1]), int(m[2]))
    else:
        number = {"double": T.DoubleType(), "float": T.FloatType()}.get(kind)
    text = T.StringType() if kind == "binary" and note.startswith("STRING") else None
    if isinstance(target, T.TimestampNTZType):
        if kind == "int32" and note == "DATE":
            return T.DateType()
        zoned = kind == "int96" or note.startswith("TIMESTAMP(") and note.endswith(",true")
        if zoned or note.startswith("TIMESTAMP("):
            # Without its zone a zoned stamp has no wall clock; the fleet must say how to read it.
            return None if zoned and isinstance(timestamp_type, T.TimestampNTZType) else timestamp_type
        return text
    return number or text


def plan_files(files: list[FileFacts], spec: str | FleetSpec) -> FilePlan:
    """Group readable files by the schema to read them with; quarantine the others."""
    spec = fleet(spec)
    default = {f.name: f.dataType for f in spec.read_schema().fields}
    groups: dict[str, tuple[T.StructType, list[FileFacts]]] = {}
    out: dict[str, str] = {}
    for f in files:
        if f.error is not None:
            out[f.path] = f.error
            continue
        fields, bad = [], []
        for target, source in spec.columns.items():
            found = f.types.get(source.lower())
            kind = default[source] if found is None else read_type(found, UNIFIED_TYPES[target], spec.timestamp_type)
            if kind is None:
                bad.append(f"{source} is {found}, not readable as {UNIFIED_TYPES[target].simpleString()}")
            else:
                fields.append(T.StructField(source, kind, True))
        if bad:
            out[f.path] = "; ".join(bad)
        else:
            schema = T.StructType(fields)
            groups.setdefault(schema.simpleString(), (schema, []))[1].append(f)
    return FilePlan(spec, [groups[k] for k in sorted(groups)], out)


def read_group(spark: SparkSession, schema: T.StructType, files: list[FileFacts],
               ignore_corrupt_files: bool = False) -> DataFrame:
    """One scan over files that share a read schema."""
    reader = spark.read.schema(schema)
    if ignore_corrupt_files:
        reader = reader.option("ignoreCorruptFiles", "true")
    return reader.parquet(*[f.path for f in files])


def _plain(path: str) -> str:
    """A path in one form: scans report them with three slashes (and URL-encoded)."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def damaged_files(spark: SparkSession, schema: T.StructType, files: list[FileFacts]) -> dict[str, str]:
    """Files whose columns cannot be read to the last row, found in one distributed scan that
    skips what fails and counts the rows of every file."""
    read = read_group(spark, schema, files, ignore_corrupt_files=True)
    seen = (read.select(F.col("_metadata.file_path").alias("path"), F.xxhash64(*schema.fieldNames()).alias("h"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.max("h").alias("h")))  # h: read every column
    counts: dict[str, int] = defaultdict(int)
    for row in seen.collect():  # one row per file
        counts[_plain(unquote(row["path"]))] += row["n"]
    return {f.path: f"{counts[_plain(f.path)]} of {f.rows} rows can be read" for f in files
            if counts[_plain(f.path)] != f.rows}


def file_report(spark: SparkSession, plans: list[FilePlan], files: dict[str, list[FileFacts]]) -> DataFrame:
    """All checked files as a table: what they hold, and why any was left out."""
    rows = [(p.spec.name, f.path, f.size, f.modified, f.rows, f.types, p.quarantined.get(f.path))
            for p in plans for f in files[p.spec.name]]
    return spark.createDataFrame(rows, FACTS)

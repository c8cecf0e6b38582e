"""Session helpers: a tuned local session for tests/bench and shared
scratch locations derived from the cluster's ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on; the cluster's own values win when present.
RECOMMENDED_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tripaudit") -> SparkSession:
    """Local session for tests and the bench (never used by the library)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.ui.showConsoleProgress", "false"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint root, setting one only where the session has
    none.  On a cluster the configured shared folder is required (a
    machine-local folder would not survive executor loss); a temporary
    folder is made only for local-mode sessions such as tests."""
    root = checkpoint_root(spark)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root
    if fallback is None:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        fallback = tempfile.mkdtemp(prefix="tripaudit-ckpt-")
    root = fallback
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


@contextmanager
def conf_held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that are run inside."""
    own = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, own)


#: Files of a partitioned write that one task keeps open before it sorts the rest of its rows.
OPEN_FILES = 16


def open_files(spark: SparkSession):
    """Partitioned writes inside do not sort a task's rows by partition first, so a task that
    has few partitions holds the files it writes and not its rows."""
    return conf_held(spark, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the shared checkpoint root for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tripaudit-{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _located(spark: SparkSession, path: str):
    """(file system, path) of a path on whatever file system holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where it does not exist."""
    fs, at = _located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file, whole."""
    fs, at = _located(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file at once: it appears under its name only when it is whole."""
    fs, at = _located(spark, path)
    part = at.suffix("._part")
    stream = fs.create(part, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"cannot write {path}")


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or folder within one file system."""
    fs, at = _located(spark, path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    if not fs.rename(at, target):
        raise OSError(f"cannot move {path} to {to}")

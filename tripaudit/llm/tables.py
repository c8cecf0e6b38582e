"""Reading the corpus tables and writing intermediate ones to the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.session import conf_held, delete_path, scratch_path

#: Lists that get the paths of tables written while they are open, innermost last.
_NOTED: list[list[str]] = []
SHUFFLE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One corpus table, pruned to ``cols`` when given."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table under ``spark.checkpoint.dir`` and read it
    back: cuts the lineage, so a lost executor only means re-reading files.  What was shuffled
    for it is deleted once it is written, not when the driver next collects its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _NOTED:
        _NOTED[-1].append(path)
    with conf_held(spark, SHUFFLE_CONF, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables written inside, for whoever knows when they are spent."""
    _NOTED.append([])
    try:
        yield _NOTED[-1]
    finally:
        _NOTED.pop()


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete spent tables and forget them."""
    while paths:
        delete_path(spark, paths.pop())


def pieces(batch, limit: int = 4 << 20):
    """Cut an Arrow record batch into slices of about ``limit`` bytes, so that the
    working memory of a task does not depend on how many rows a batch holds."""
    n = batch.num_rows
    if n == 0:
        return
    step = max(1, int(n * limit / max(batch.nbytes, 1)))
    for i in range(0, n, step):
        yield batch.slice(i, step)
    pa.default_memory_pool().release_unused()


#: Rows of one Arrow batch, of text or of whole sets, between the JVM and a Python worker.
ARROW_ROWS, ARROW_CONF = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(function: Callable) -> Callable:
    """An operator on ``docs`` that runs its jobs with at most ``ARROW_ROWS`` rows a batch:
    a batch lies whole outside the heap of an executor, and once more in its Python worker."""
    @wraps(function)
    def run(docs: DataFrame, *args, **kwargs):
        own = int(docs.sparkSession.conf.get(ARROW_CONF))
        with conf_held(docs.sparkSession, ARROW_CONF, str(min(own, ARROW_ROWS) if own > 0 else ARROW_ROWS)):
            return function(docs, *args, **kwargs)

    return run


def aside(docs: DataFrame, *named: str):
    """Rename all columns but ``named`` so that an operator's columns cannot clash with
    them; returns the renamed table and a function that gives a result its old columns."""
    plain = [c if c in named else f"_{i}" for i, c in enumerate(docs.columns)]

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(p).alias(c) for p, c in zip(plain, docs.columns, strict=True)])

    return docs.toDF(*plain), back

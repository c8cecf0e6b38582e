"""From raw documents to packed training sequences, stage by stage.

Each stage works on all its predecessor kept, and its decisions take effect:

1. ``language_id`` drops documents without letters and those in which no language has a
   clear share of the words.
2. ``near_duplicates`` keeps the document with the smallest id of every component of
   documents that share three quarters of their 5-word shingles.
3. ``decontaminate`` drops documents that hold a window of a benchmark item.
4. ``redact_pii`` replaces personal data by its kind.
5. ``pack`` tokenises what is left and packs it into sequences of 2048 tokens.

Stages hand on Parquet tables in the folder named by ``spark.checkpoint.dir``; all but the
last return the columns of ``documents``.  An empty table passes through every stage.  What a
stage wrote on its way is deleted when the next one begins, as its result is written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tripaudit.llm.decontam import drop_contaminated
from tripaudit.llm.jaccard import one_per_component
from tripaudit.llm.langid import keep_identified
from tripaudit.llm.packing import pack_documents
from tripaudit.llm.pii import redact_documents
from tripaudit.llm.tables import delete_tables, noted, table, written

_spent: list[str] = []


def _stage(function: Callable) -> Callable:
    """A stage that clears the tables of the one before it and notes its own."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_tables(spark, _spent)
        with noted() as paths:
            out = function(spark, docs, sf_dir)
        _spent.extend(paths)
        return out

    return run_stage


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_component(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@_stage
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_documents(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("pack", pack),
]
#: Learned models, components and token ids have no SQL; tests hold brute force against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

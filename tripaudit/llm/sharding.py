"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on a ring of 2^40 positions.  Keys are placed in
ring order; a key goes to the shard of the first point at or after its own position
and, where that shard is full, continues clockwise to the next shard with room.

With ``eps=0`` the capacities are ``n // shards`` or one more, so counts differ by one
at most (law ``rows``); with ``eps > 0`` every shard takes at most
``ceil((1 + eps) * n / shards)`` keys and fewer keys leave their home shard.

The walk is never run row by row: rows are counted per ring interval, the intervals
(a number bounded by the parameters and ``n / rows_per_cell``) are walked once, and
every row then finds its shard by its rank inside its interval.

Defined results: null text counts as no bytes and CRC 0; null or repeated ``doc_id`` are
placed like any other value; identical rows are counted first and take consecutive
slots; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripaudit.llm.tables import table, written

RING_BITS = 40
#: Copies of one row that a task writes out at most.
CHUNK = 4096
SCHEMA = ("doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, "
          "grown_shard int")


def position(*cols):
    """Ring position of a key."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << RING_BITS))


def ring_points(spark: SparkSession, shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, in ring order."""
    points = (spark.range(shards * vnodes, numPartitions=1)
              .select(F.expr(f"int(id div {vnodes})").alias("shard"), (F.col("id") % vnodes).alias("v"))
              # A shard's points are its own: they stay when shards are added.
              .select("shard", position(F.lit("vnode"), F.col("shard"), F.col("v")).alias("pos")))
    return sorted((r.pos, r.shard) for r in points.collect())


def ring_intervals(points: list[tuple[int, int]], cells: int) -> list[tuple[int, int, int, int]]:
    """(lo, hi, cell, point) ranges of positions that share a cell of the even grid and
    the point that serves them.  Positions after the last point go to the first."""
    width = (1 << RING_BITS) // cells
    at = [p for p, _ in points]
    cuts = sorted({*range(0, 1 << RING_BITS, width), *(p + 1 for p in at if p + 1 < 1 << RING_BITS)})
    out = []
    for lo, hi in zip(cuts, [*cuts[1:], 1 << RING_BITS], strict=True):
        out.append((lo, hi, lo // width, bisect.bisect_left(at, lo) % len(at)))
    return out


def walk(counts: list[int], homes: list[int], owner: list[int], room: list[int]):
    """Place ``counts[i]`` keys of interval i, in ring order, at the first shard with room
    clockwise from point ``homes[i]``.  Yields (interval, from_rank, to_rank, shard,
    first_slot)."""
    used = [0] * len(room)
    for i, (n, home) in enumerate(zip(counts, homes, strict=True)):
        done, at = 0, home
        while done < n:
            shard = owner[at]
            if take := min(n - done, room[shard] - used[shard]):
                yield i, done, done + take, shard, used[shard]
                used[shard] += take
                done += take
            at = (at + 1) % len(owner)


def ring_shards(keys: DataFrame, shards: int = 40, vnodes: int = 64, eps: float = 0.0,
                rows_per_cell: int = 500_000) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 within a shard) to every row of ``keys``.

    All columns of ``keys`` make up a row's key; it should be a written table, as it is
    read three times.
    """
    spark, cols = keys.sparkSession, keys.columns
    n = keys.count()
    cells = 1 << max(math.ceil(math.log2(4 * shards * vnodes)), math.ceil(math.log2(n / rows_per_cell + 1)))
    points = ring_points(spark, shards, vnodes)
    spans = ring_intervals(points, cells)
    # Bounded: cells + points rows, of 40 bytes each.
    lookup = F.broadcast(spark.createDataFrame(
        [(lo, hi, cell, i) for i, (lo, hi, cell, _) in enumerate(spans)],
        "_lo bigint, _hi bigint, _cell bigint, _i int"))
    width = (1 << RING_BITS) // cells
    placed = (keys.withColumn("_pos", position(*cols))
              .withColumn("_cell", F.expr(f"_pos div {width}"))
              .join(lookup, "_cell").where("_pos >= _lo and _pos < _hi").drop("_cell", "_lo", "_hi"))
    counts = [0] * len(spans)
    for r in placed.groupBy("_i").count().collect():  # one small row per interval
        counts[r["_i"]] = r["count"]
    if eps > 0:
        room = [math.ceil((1 + eps) * n / shards)] * shards
    else:
        room = [n // shards + (s < n % shards) for s in range(shards)]
    plan = F.broadcast(spark.createDataFrame(
        list(walk(counts, [home for *_, home in spans], [s for _, s in points], room)),
        "_i int, _from bigint, _to bigint, shard int, _slot bigint"))
    # Identical rows collapse on the map side, so a row repeated many times is one row here.
    order = Window.partitionBy("_i").orderBy("_pos", *cols)
    ranked = (placed.groupBy("_i", "_pos", *cols).agg(F.count("*").alias("_n"))
              .withColumn("_rank", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")))
    chunks = (ranked.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {CHUNK}"))))
              .repartition("_pos", "_chunk"))
    each = chunks.withColumn("_rank", F.explode(F.sequence(
        F.col("_rank") + F.col("_chunk") * CHUNK,
        F.col("_rank") + F.least(F.col("_n"), (F.col("_chunk") + 1) * CHUNK) - 1)))
    return (each.join(plan, "_i").where("_rank >= _from and _rank < _to")
            .select(*cols, "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot")))


def document_keys(docs: DataFrame) -> DataFrame:
    """doc_id, size in bytes plus 16, and CRC-32 of every document's text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"),
                       F.crc32(text).alias("text_crc32"))


def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 40 shards, counts at most one apart."""
    keys = written(document_keys(table(spark, sf_dir, "documents", "doc_id", "text")), "ring-keys")
    out = ring_shards(keys)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))

"""Missing-month imputation (AGG-13/14, FLT-5/11, IMP-1/2, PRJ-10/11, SET-2).

The target month is filled from the same month one year earlier, sized by a
weighted average of the two previous years.  Two sampling modes:

* ``sampled`` - Poisson sample with replacement: every row draws its number
  of copies from a uniform that is a function of the seed and the row alone
  (md5), so the same rows give the same sample under any layout; its size is
  only approximately the target.
* ``exact``   - deterministic: with the base month's n rows in a fixed
  order, row i is repeated ``floor((i+1)t/n) - floor(it/n)`` times, so the
  output holds exactly t rows for any t/n (also above 1).

The exact mode never orders the month in one task.  Identical rows are
first collapsed into one row with a multiplicity m (a group of copies,
however large, becomes one row; map-side combine does the work).  A group
spanning positions [S, E) receives ``floor(E t/n) - floor(S t/n)`` copies,
which is the sum of the per-row formula.  E comes from range partitioning
on the full sort key (balanced by sampling, so no minute or timestamp is a
hot key), a running sum inside each range, and per-range offsets (one row
per range, broadcast).  Copy counts are cut into bounded chunks that are
hash-spread over tasks before expansion.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripaudit.config import DEFAULT, AuditConfig
from tripaudit.functions.time import days_to_next_year, in_month, shift_days
from tripaudit.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

# Distinct rows per range partition when placing the base month.
ROWS_PER_RANGE = 1_000_000
# Largest number of copies expanded from one chunk row.
EXPAND_CHUNK = 4096
# Output rows generated per task by the expansion.
OUTPUT_ROWS_PER_TASK = 2_000_000


class ImputePlan(NamedTuple):
    n_base_old: int
    n_base_new: int
    n_target: int
    target: int
    fraction: float | None
    action: str


def _months(cfg: AuditConfig):
    y, m = cfg.impute_year, cfg.impute_month
    return in_month("pickup_time", y - 2, m), in_month("pickup_time", y - 1, m), \
        in_month("pickup_time", y, m)


def _decide(n_old, n_new, n_target, cfg: AuditConfig):
    w_old, w_new = cfg.history_weights
    target = F.floor(F.lit(float(w_old)) * n_old + F.lit(float(w_new)) * n_new).cast("bigint")
    fraction = F.when(n_new > 0, target / n_new)
    action = (F.when(n_target > cfg.present_threshold, F.lit("present"))
              .when(target == 0, F.lit("no_history"))
              .when(n_new == 0, F.lit("empty_base"))
              .otherwise(F.lit("impute")))
    return target, fraction, action


def impute_counts(trips: DataFrame, cfg: AuditConfig = DEFAULT) -> DataFrame:
    """One row: ``n_base_old, n_base_new, n_target, target, fraction,
    action``, from one conditional-count pass.  The month ranges are
    written as timestamp bounds so they reach the Parquet reader."""
    old, new, tgt = _months(cfg)

    def n(cond):
        return F.count(F.when(cond, F.lit(1)))

    counts = trips.filter(old | new | tgt).agg(
        n(old).alias("n_base_old"), n(new).alias("n_base_new"), n(tgt).alias("n_target"))
    target, fraction, action = _decide(F.col("n_base_old"), F.col("n_base_new"),
                                       F.col("n_target"), cfg)
    return counts.select("n_base_old", "n_base_new", "n_target", target.alias("target"),
                         fraction.alias("fraction"), action.alias("action"))


def plan_imputation(trips: DataFrame, cfg: AuditConfig = DEFAULT,
                    spark: SparkSession | None = None,
                    raw_dir: str | None = None) -> ImputePlan:
    """Collect the one-row decision.  When the older history month is not
    among the trips and ``raw_dir`` is given, its raw files are counted
    instead (fallback history scan)."""
    row = impute_counts(trips, cfg).first()
    n_old, n_new, n_target = row["n_base_old"], row["n_base_new"], row["n_target"]
    return fallback_plan(n_old, n_new, n_target, cfg, spark, raw_dir)


def fallback_plan(n_old: int, n_new: int, n_target: int, cfg: AuditConfig,
                  spark: SparkSession | None = None, raw_dir: str | None = None,
                  history: Mapping[str, int] | None = None) -> ImputePlan:
    """The decision for counted months, with the fallback where it applies: the older month's
    raw files are counted in ``raw_dir``, or looked up by name in ``history``, the row counts
    that an intake has kept."""
    if n_old == 0 and n_target <= cfg.present_threshold:
        y, m = cfg.impute_year - 2, cfg.impute_month
        if raw_dir and spark is not None:
            from tripaudit.sources.trips import count_history_files

            n_old = count_history_files(spark, raw_dir, y, m)
        elif history:
            n_old = sum(n for name, n in history.items() if name.endswith(f"tripdata_{y}-{m:02d}.parquet"))
    w_old, w_new = cfg.history_weights
    target = math.floor(float(w_old) * n_old + float(w_new) * n_new)
    action = ("present" if n_target > cfg.present_threshold else
              "no_history" if target == 0 else
              "empty_base" if n_new == 0 else "impute")
    return ImputePlan(n_old, n_new, n_target, target, target / n_new if n_new else None, action)


def _floor_scaled(pos: str, target: int, n: int) -> F.Column:
    """floor(pos * target / n) in exact integer arithmetic (DECIMAL(38,0)
    product, so no BIGINT overflow for month-sized counts)."""
    return F.expr(f"(CAST({pos} AS DECIMAL(38,0)) * {int(target)}) div {int(n)}")


def place_groups(groups: DataFrame, order: list[F.Column], n: int,
                 rows_per_range: int = ROWS_PER_RANGE) -> tuple[DataFrame, int]:
    """Add ``_end``, the global running multiplicity in ``order``, to a frame
    of distinct rows with multiplicity ``_m``, without a global sort.  Also
    returns the placed total (``n`` is only a sizing hint).

    Rows are range-partitioned on the full sort key (Spark samples the
    bounds, so a crowded minute or timestamp is split like any other key
    range), summed inside each range, and the ranges are stacked with
    offsets from a table of one row per range.  The checkpoint pins the
    sampled bounds, so row positions and range totals come from the same
    assignment even if a later stage is retried, and cuts the lineage."""
    spark = groups.sparkSession
    # Sized by the data (``n`` bounds the distinct rows), not by the
    # session's shuffle width: a 4-billion-row month gets ~4000 ranges, a
    # tiny one a single range.
    p = max(1, -(-n // rows_per_range))
    within = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # The window needs its rows by range id; the width is given, as the planner's
    # would be the session's.
    ranged = (groups.repartitionByRange(p, *order)
              .withColumn("_p", F.spark_partition_id())
              .repartition(p, "_p")
              .withColumn("_local", F.sum("_m").over(within)))
    ensure_checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    # One row per range (at most p rows): safe to sort in one task and broadcast.
    stacked = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.groupBy("_p").agg(F.max("_local").alias("_t"))
    offsets = totals.select("_p", (F.sum("_t").over(stacked) - F.col("_t")).alias("_off"))
    placed_total = totals.agg(F.sum("_t")).first()[0] or 0
    placed = (ranged.join(F.broadcast(offsets), "_p")
              .withColumn("_end", F.col("_off") + F.col("_local")))
    return placed, int(placed_total)


def exact_sample(base: DataFrame, target: int, n: int, chunk: int = EXPAND_CHUNK,
                 rows_per_range: int = ROWS_PER_RANGE,
                 rows_per_task: int = OUTPUT_ROWS_PER_TASK) -> DataFrame:
    """Exactly ``target`` rows drawn with replacement from ``base`` (n rows)
    by the deterministic spread described in the module docstring.  Row
    order is all columns ascending, NULLs first; only the multiset of the
    output is defined.  Runs one job eagerly (the placement checkpoint)."""
    if n <= 0 or target <= 0:
        return base.limit(0)
    cols = base.columns
    order = [F.asc_nulls_first(c) for c in cols]
    groups = base.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    placed, n = place_groups(groups, order, n, rows_per_range)
    if n <= 0:
        return base.limit(0)
    # n is taken from the placed (checkpointed) rows, so the output holds
    # exactly ``target`` rows even if the base changed since it was counted.
    placed = (placed
              .withColumn("_start", F.col("_end") - F.col("_m"))
              .withColumn("_copies", _floor_scaled("_end", target, n)
                          - _floor_scaled("_start", target, n))
              .filter(F.col("_copies") > 0)
              .select(*cols, "_copies"))

    # Cut every row's copies into chunks of at most ``chunk`` and spread the
    # chunk rows by (chunk index, row) before expanding, so a large group of
    # copies is generated by many tasks, never by the one that placed it.
    # The partition count is explicit and sized by the *output*: a chunk row
    # is tiny but stands for up to ``chunk`` rows, so AQE must not coalesce
    # this exchange by its (small) shuffle size.
    parts = max(1, -(-target // rows_per_task))
    chunks = (placed
              .withColumn("_j", F.explode(F.sequence(
                  F.lit(0).cast("bigint"), F.ceil(F.col("_copies") / chunk) - 1)))
              .withColumn("_size", F.least(F.lit(chunk).cast("bigint"),
                                           F.col("_copies") - F.col("_j") * chunk))
              .repartition(parts, "_j", *cols))
    return (chunks.withColumn("_k", F.explode(F.array_repeat(F.lit(True),
                                                             F.col("_size").cast("int"))))
            .select(*cols))


def row_key(cols: list[str], types: dict[str, str], seed: int) -> F.Column:
    """Text key of a row that other SQL engines can build alike: amounts as whole
    hundredths, other values as their text, NULL as a mark of its own."""
    def part(c):
        v = F.col(c)
        if types[c] == "double":
            v = F.round(v * 100).cast("bigint")
        return F.coalesce(v.cast("string"), F.lit("~"))

    return F.concat_ws("|", F.lit(str(seed)), *[part(c) for c in cols])


def poisson_steps(mean: float) -> list[float]:
    """Cumulative probabilities of a Poisson count, up to where they no longer grow."""
    if not 0 <= mean <= 500:
        raise ValueError(f"{mean} copies a row are not sampled; use the exact mode")
    steps, p, total, k = [], math.exp(-mean), 0.0, 0
    while not steps or (total + p > total and k < 2000):
        total += p
        steps.append(total)
        k += 1
        p *= mean / k
    return steps


def poisson_sample(base: DataFrame, fraction: float, seed: int, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Every row of ``base`` zero or more times, Poisson distributed with mean ``fraction``.

    Equal rows are counted first and told apart by an ordinal, so a row that is repeated
    many times is one row on the way and is expanded in chunks spread over tasks."""
    cols = base.columns
    types = dict(base.dtypes)
    groups = base.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
    chunks = (groups.withColumn("_j", F.explode(F.expr(f"sequence(0, (_m - 1) div {chunk})")))
              .repartition("_j", *cols))
    rows = chunks.withColumn("_i", F.explode(F.expr(
        f"sequence(_j * {chunk}, least(_m, (_j + 1) * {chunk}) - 1)")))
    key = F.concat(row_key(cols, types, seed), F.lit("|"), F.col("_i").cast("string"))
    u = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    steps = F.array(*[F.lit(x) for x in poisson_steps(float(fraction))])
    copies = F.size(F.filter(steps, lambda x: u >= x))
    return (rows.withColumn("_copies", copies).filter("_copies > 0")
            .withColumn("_c", F.explode(F.array_repeat(F.lit(True), F.col("_copies")))).select(*cols))


def imputed_rows(base: DataFrame, plan: ImputePlan, cfg: AuditConfig = DEFAULT, mode: str = "exact") -> DataFrame:
    """Rows of the base month drawn to the plan's size and moved to the same day and time one
    year on (29 February to 28 February).  A drop-off moves by as many days as its pick-up."""
    if mode == "exact":
        rows = exact_sample(base, plan.target, plan.n_base_new)
    else:
        rows = poisson_sample(base, plan.fraction, cfg.impute_seed)
    return (rows.withColumn("_days", days_to_next_year("pickup_time"))
            .withColumn("pickup_time", shift_days("pickup_time", F.col("_days")))
            .withColumn("dropoff_time", shift_days("dropoff_time", F.col("_days"))).drop("_days"))


def impute_month(trips: DataFrame, cfg: AuditConfig = DEFAULT, mode: str = "exact",
                 plan: ImputePlan | None = None, spark: SparkSession | None = None,
                 raw_dir: str | None = None) -> DataFrame:
    """``trips`` plus imputed rows for the target month, flagged by
    ``is_imputed``: base-month rows moved to the same day of the target month with
    their time of day kept.  A present target month is topped up, never
    replaced.  Any failed guard returns the input unchanged (with
    ``is_imputed = false``)."""
    if mode not in ("exact", "sampled"):
        raise ValueError(f"unknown imputation mode: {mode}")
    plan = plan or plan_imputation(trips, cfg, spark, raw_dir)
    real = trips.withColumn("is_imputed", F.lit(False))
    if plan.action != "impute":
        log.info("imputation skipped: %s", plan.action)
        return real
    _, new, _ = _months(cfg)
    rows = imputed_rows(trips.filter(new), plan, cfg, mode)
    return real.unionByName(rows.withColumn("is_imputed", F.lit(True)))

"""The whole audit as one Spark application (FLW-4).

The footers of all raw files are checked first; then the good files are scanned once, by the
writes that stage the flagged trip table (metrics, three-valued ``is_ghost``,
``inside_zone``, ``is_imputed``) as Parquet partitioned by status (clean / audit /
undetermined) and pick-up year and month in a shared folder.  Fleets, and files of one fleet
that need different read schemas, are batches of a :class:`TripStore` and are staged side by
side.  A batch's write also counts: row accounting, the three history months and the values
that did not fit come from it as observed metrics.  One scan of the staged batch then leaves
its partial aggregates, and every report is merged from those.  The base month of the
imputation is read from its staged partition; the imputed rows are one more batch.

Given a store that outlives the run, a rerun skips every batch whose files have not changed,
and a month that landed since adds its own batch and partials only.

Nothing is left out silently: a file, fleet, report or weather step that fails ends the run
unless the caller opts into leaving it out, and then the result lists it and is not
``complete``.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException
from pyspark.util import inheritable_thread_target

from tripaudit.config import DEFAULT, AuditConfig
from tripaudit.functions.time import in_month
from tripaudit.functions.trips import (
    ghost_flag,
    rule_fast,
    rule_short_expensive,
    rule_zero_distance,
)
from tripaudit.operators import (
    ImputePlan,
    audit_leakage,
    border_effect,
    daily_trips,
    derive_metrics,
    fallback_plan,
    ghost_vendors,
    imputed_rows,
    mark_zone,
    merged_daily,
    merged_reports,
    partial_states,
    period_summary,
    q1_comparison,
    rain_elasticity,
    rain_join,
    rain_trend,
    surcharge_compliance,
    tip_vs_surcharge,
    velocity_heatmap,
    volume_by_quarter,
)
from tripaudit.plans.store import LAYOUT, STAGED_SCHEMA, Batch, TripStore, digest
from tripaudit.schema import UNIFIED_COLUMNS, FleetSpec, fleet, ids_lost, unify_schema
from tripaudit.session import delete_path, scratch_path
from tripaudit.sources import (
    check_files,
    damaged_files,
    in_year,
    plan_files,
    read_csv,
    read_group,
    source_counts,
    unread_days,
    write_csv,
    write_parquet,
)
from tripaudit.sources.trips import path_missing

log = logging.getLogger(__name__)

ACCOUNTING_COLUMNS = ("total", "clean", "audit", "undetermined", "rule_a", "rule_b", "rule_c")
MONTHS = ("n_base_old", "n_base_new", "n_target")
PREVIEWED = ("row_accounting", "ghost_vendors", "surcharge_compliance", "audit_leakage", "rain_correlation")


#: Input bytes of one batch: what a stopped run loses at most, and a new month's smallest unit.
BATCH_BYTES = 1 << 40
STAGING_THREADS = 4


@dataclass
class Staged:
    """A staged table and what its writes counted.  ``path`` is the folder of its batches;
    ``quarantined`` lists the files that were left out."""

    path: str
    counts: Counter
    plan: ImputePlan
    skipped_fleets: dict[str, str] = field(default_factory=dict)
    store: TripStore | None = None
    batches: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    quarantined: dict[str, str] = field(default_factory=dict)

    def trips(self) -> DataFrame:
        return self.store.read_trips(self.batches)

    def partials(self) -> DataFrame:
        return self.store.read_partials(self.batches)


@dataclass
class AuditResult:
    staged_path: str | None = None
    audit_path: str | None = None
    reports: dict[str, str] = field(default_factory=dict)
    frames: dict[str, DataFrame] = field(default_factory=dict)
    imputation: ImputePlan | None = None
    skipped_fleets: dict[str, str] = field(default_factory=dict)
    quarantined: dict[str, str] = field(default_factory=dict)
    failed_reports: dict[str, str] = field(default_factory=dict)
    reused_batches: list[str] = field(default_factory=list)
    ids_lost: int = 0
    unread_weather_days: int = 0
    corrupt_files_ignored: bool = False

    @property
    def complete(self) -> bool:
        return self.audit_path is not None and not (self.skipped_fleets or self.quarantined or self.failed_reports)


def accounting_metrics(cfg: AuditConfig = DEFAULT) -> list[F.Column]:
    """Row accounting as aggregate expressions over a flagged frame."""
    g = F.col("is_ghost")

    def n(cond):
        return F.count(F.when(cond, F.lit(1)))

    return [F.count(F.lit(1)).alias("total"), n(~g).alias("clean"), n(g).alias("audit"),
            n(g.isNull()).alias("undetermined"), n(rule_fast(cfg)).alias("rule_a"),
            n(rule_short_expensive(cfg)).alias("rule_b"),
            n(rule_zero_distance(cfg)).alias("rule_c")]


def month_metrics(cfg: AuditConfig = DEFAULT) -> list[F.Column]:
    """Rows of the two history months and of the target month."""
    y, m = cfg.impute_year, cfg.impute_month
    return [F.count(F.when(in_month("pickup_time", year, m), 1)).alias(name)
            for name, year in zip(MONTHS, (y - 2, y - 1, y), strict=True)]


def flagged(trips: DataFrame, cfg: AuditConfig = DEFAULT, imputed: bool = False) -> DataFrame:
    """Unified trips in the layout of the staged table."""
    g = F.col("is_ghost")
    return (mark_zone(derive_metrics(trips, cfg).withColumn("is_ghost", ghost_flag(cfg)), cfg.zone_ids)
            .withColumn("is_imputed", F.lit(imputed))
            .withColumn("status", F.when(g, F.lit("audit")).when(~g, F.lit("clean")).otherwise(F.lit("undetermined")))
            .withColumn("year", F.year("pickup_time"))
            .withColumn("month", F.month("pickup_time")))


def write_batch(rows: DataFrame, store: TripStore, batch: Batch, cfg: AuditConfig, *more: Observation) -> Batch:
    """Stage flagged rows as one batch: trips, then partials from one scan of them, then the
    record.  The write of the trips counts them (Spark merges the observed metrics from
    successful task attempts only).

    Partitioned by status too, so the audit sink prunes whole directories.  No shuffle before
    the write: a month would land in one task."""
    seen = Observation()
    rows.observe(seen, *accounting_metrics(cfg), *month_metrics(cfg)).write.mode("overwrite") \
        .partitionBy(*LAYOUT).parquet(store.trips(batch.name))
    for found in (seen, *more):
        batch.counts |= found.get
    partial_states(store.read_trips([batch.name])).write.mode("overwrite").parquet(store.partials(batch.name))
    return store.commit(batch)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    """All batches under a staged table's folder (a finished run's; ``Staged.trips`` goes by
    the manifest)."""
    return spark.read.schema(STAGED_SCHEMA).parquet(path).select(*STAGED_SCHEMA.fieldNames())


class UnreadableFiles(ValueError):
    """Files of a fleet that cannot be read, with the reasons."""

    def __init__(self, name: str, files: dict[str, str]):
        super().__init__(f"files of fleet {name} cannot be read: " + "; ".join(f"{p}: {r}" for p, r in files.items()))
        self.files = files


def rules_key(cfg: AuditConfig) -> str:
    """The settings that decide what a flagged row and a batch's counts are."""
    used = ("speed_limit_mph", "min_trip_seconds", "short_trip_fare", "min_hours_for_speed", "zone_ids",
            "impute_year", "impute_month")
    return digest({k: getattr(cfg, k) for k in used}, STAGED_SCHEMA.simpleString())


def settings_key(spec: FleetSpec, cfg: AuditConfig) -> str:
    """What, besides the files, decides what a batch holds."""
    return digest(rules_key(cfg), spec.name, spec.columns, spec.timestamp_type.simpleString())


def _pack(files: list, limit: int) -> Iterable[list]:
    """Files in order, as many to a batch as ``limit`` bytes allow."""
    pack, size = [], 0
    for f in files:
        if pack and size + f.size > limit:
            yield pack
            pack, size = [], 0
        pack.append(f)
        size += f.size
    if pack:
        yield pack


class Stager:
    """Stages the files of one fleet that no committed batch of the store holds."""

    def __init__(self, spark, raw_dir, spec, store, live, cfg, quarantine_files, ignore_corrupt_files, batch_bytes):
        self.spark, self.spec, self.store, self.cfg = spark, spec, store, cfg
        self.settings, self.batch_bytes = settings_key(spec, cfg), batch_bytes
        self.quarantine, self.ignore = quarantine_files, ignore_corrupt_files
        self.plan = plan_files(check_files(spark, raw_dir, spec), spec)
        self.left_out: dict[str, str] = {}
        self.leave_out(self.plan.quarantined)
        here = {f.key for _, files in self.plan.groups for f in files}
        own = [b for b in live.values() if b.fleet == spec.name and b.settings == self.settings]
        held: set[tuple] = set()
        self.kept: list[Batch] = []
        for b in sorted(own, key=lambda b: (-len(b.files), b.name)):
            files = {tuple(f) for f in b.files}
            if files <= here and not files & held:  # as it was staged, and no file twice
                held |= files
                self.kept.append(b)
        self.stale = [b for b in own if b not in self.kept]
        self.todo = [(schema, pack) for schema, files in self.plan.groups
                     for pack in _pack([f for f in files if f.key not in held], batch_bytes)]

    def leave_out(self, files: dict[str, str]) -> None:
        if files and not (self.quarantine or self.ignore):
            raise UnreadableFiles(self.spec.name, files)
        for path, reason in files.items():
            log.warning("file %s left out: %s", path, reason)
        self.left_out |= files

    def stage(self, schema: T.StructType, files: list) -> Batch:
        """One batch; files with damaged pages are told from good ones only when it fails."""
        raw = read_group(self.spark, schema, files, self.ignore)
        lost = Observation()
        trips = unify_schema(raw.observe(lost, ids_lost(raw, self.spec).alias("ids_lost")), self.spec)
        keys = sorted(f.key for f in files)
        batch = Batch(digest(keys, self.settings, schema.simpleString()), self.spec.name, self.settings,
                      [list(k) for k in keys])
        try:
            return write_batch(flagged(trips, self.cfg), self.store, batch, self.cfg, lost)
        except Exception:
            self.store.drop(batch.name)
            bad = damaged_files(self.spark, schema, files) if self.quarantine else {}
            if not bad:
                raise
            self.leave_out(bad)
        good = [f for f in files if f.path not in bad]
        return self.stage(schema, good) if good else None


def stage_imputed(base: DataFrame, plan: ImputePlan, store: TripStore, files: list, cfg: AuditConfig,
                  mode: str, live: dict[str, Batch]) -> Batch:
    """Stage the rows imputed from the base month of staged trips, which came from ``files``,
    unless a batch holds them."""
    y, m = cfg.impute_year, cfg.impute_month
    settings = digest("imputed", rules_key(cfg), cfg.impute_seed, cfg.history_weights, cfg.present_threshold, mode)
    name = digest(sorted(files), list(plan), settings)
    if name in live:
        return live[name]
    month = base.filter((F.col("year") == y - 1) & (F.col("month") == m)).select(*UNIFIED_COLUMNS)
    rows = flagged(imputed_rows(month, plan, cfg, mode), cfg, imputed=True)
    return write_batch(rows, store, Batch(name, "", settings), cfg)


def _without_months(counts: dict[str, int]) -> Counter:
    """Counts of an imputed batch: its rows are no history."""
    return Counter({k: n for k, n in counts.items() if k not in MONTHS})


def stage_audit(spark: SparkSession, raw_dir: str, cfg: AuditConfig = DEFAULT,
                impute_mode: str = "exact", fleets=None, path: str | None = None,
                skip_failed_fleets: bool = False, ignore_corrupt_files: bool = False,
                quarantine_files: bool = False, batch_bytes: int = BATCH_BYTES) -> Staged | None:
    """Intake -> staged batches -> imputation as one more; None when there is no trip data.
    The only step that reads raw files, and it reads their rows once.

    ``path`` is the root of a store that a rerun finds again (a fresh scratch folder unless
    given).  A file that cannot be read ends the run; ``quarantine_files`` leaves such files
    out and lists them, ``skip_failed_fleets`` leaves their fleet out whole, and
    ``ignore_corrupt_files`` also makes scans skip pages that fail."""
    store = TripStore(spark, path or scratch_path(spark, "staged-trips"))
    live = store.committed()
    store.clear_leftovers()
    skipped: dict[str, str] = {}
    stagers: list[Stager] = []

    def failed(name: str, exc: Exception) -> None:
        if not skip_failed_fleets:
            raise exc
        log.warning("fleet %s left out: %s", name, exc)
        skipped[name] = str(exc)

    for spec in [fleet(f) for f in fleets or cfg.fleets]:
        try:
            stagers.append(Stager(spark, raw_dir, spec, store, live, cfg, quarantine_files, ignore_corrupt_files,
                                  batch_bytes))
        except Exception as exc:
            if isinstance(exc, AnalysisException) and path_missing(exc):
                log.warning("raw directory does not exist: %s", raw_dir)
                return None
            failed(spec.name, exc)

    def attempt(job):
        stager, schema, files = job
        try:
            return stager, stager.stage(schema, files), None
        except Exception as exc:
            return stager, None, exc

    # Fleets and read schemas are independent scans: submitting them from a few threads keeps
    # the executors busy while the last tasks of one of them end.
    jobs = [(s, schema, files) for s in stagers for schema, files in s.todo]
    with ThreadPoolExecutor(max_workers=STAGING_THREADS) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(attempt), jobs))
    for stager, _, exc in done:
        if exc is not None and stager.spec.name not in skipped:
            failed(stager.spec.name, exc)
    quarantined = {path: why for s in stagers for path, why in s.left_out.items()}
    kept = [b for s in stagers if s.spec.name not in skipped for b in s.kept]
    used = kept + [b for s, b, _ in done if b is not None and s.spec.name not in skipped]
    counts = sum((Counter(b.counts) for b in used), Counter())
    plan = fallback_plan(*(counts[k] for k in MONTHS), cfg, spark, raw_dir)
    log.info("imputation plan: %s", plan)
    if not counts["total"]:
        log.warning("no trip data under %s", raw_dir)
        return Staged("", counts, plan, skipped, store, quarantined=quarantined) if skipped or quarantined else None
    stale = [b for s in stagers for b in s.stale]
    if plan.action == "impute":
        extra = stage_imputed(store.read_trips([b.name for b in used]), plan, store, [f for b in used for f in b.files],
                              cfg, impute_mode, live)
        counts += _without_months(extra.counts)
        used.append(extra)
        kept += [extra] if extra.name in live else []
        stale += [b for b in live.values() if b.settings == extra.settings and b.name != extra.name]
    for b in stale:  # of files that changed or went, and imputed from those
        store.drop(b.name)
    return Staged(store.trips_path, counts, plan, skipped, store, [b.name for b in used], [b.name for b in kept],
                  quarantined)


def stage_intake(spark: SparkSession, intake: DataFrame, cfg: AuditConfig = DEFAULT,
                 impute_mode: str = "exact", raw_dir: str | None = None,
                 history: Mapping[str, int] | None = None) -> tuple[DataFrame, Staged]:
    """Start from trips that the streaming intake has flagged (``read_intake``): one pass
    leaves their partials and counts them, and only the imputed rows are staged.  A history
    month without trips is counted in ``raw_dir``, or taken from ``history``, the intake's own
    counts (``read_history``)."""
    store = TripStore(spark, scratch_path(spark, "staged-imputed"))
    real = intake.withColumn("is_imputed", F.lit(False)).select(*STAGED_SCHEMA.fieldNames())
    seen, name = Observation(), "intake"
    partial_states(real.observe(seen, *accounting_metrics(cfg), *month_metrics(cfg))).write.parquet(store.partials(name))
    counts = Counter(seen.get)
    plan = fallback_plan(*(counts[k] for k in MONTHS), cfg, spark, raw_dir, history)
    batches, path = [name], ""
    if plan.action == "impute":
        extra = stage_imputed(real, plan, store, [], cfg, impute_mode, {})
        counts += _without_months(extra.counts)
        real = real.unionByName(store.read_trips([extra.name]))
        batches.append(extra.name)
        path = store.trips_path
    return real, Staged(path, counts, plan, store=store, batches=batches)


def staged_accounting(staged: DataFrame) -> DataFrame:
    """Rows per fleet and origin (real / imputed) of a staged table, split
    into clean / audit / undetermined, with zone trips among the clean."""
    g = F.col("is_ghost")

    def n(cond):
        return F.count(F.when(cond, F.lit(1)))

    return staged.groupBy("taxi_type", "is_imputed").agg(
        F.count(F.lit(1)).alias("total"), n(~g).alias("clean"), n(g).alias("audit"),
        n(g.isNull()).alias("undetermined"), n(~g & F.col("inside_zone")).alias("clean_in_zone"))


def observed_accounting(spark: SparkSession, counts: Counter) -> DataFrame:
    """Row accounting of the whole staged table, as its writes counted it."""
    return spark.createDataFrame([tuple(counts[k] for k in ACCOUNTING_COLUMNS)],
                                 ", ".join(f"{k} bigint" for k in ACCOUNTING_COLUMNS))


def audit_reports(staged: DataFrame, cfg: AuditConfig = DEFAULT) -> dict[str, DataFrame]:
    """The reports straight from staged trips, one scan each (``merged_reports`` has the same
    from partials).  Partition filters: each reads only its directories."""
    clean = staged.filter(F.col("status") == "clean")
    audit = staged.filter(F.col("status") == "audit")
    real = staged.filter(~F.col("is_imputed"))  # as loaded, before imputation
    return {
        "source_counts": source_counts(real),
        "period_summary": period_summary(real, use_partition_columns=True),
        "ghost_vendors": ghost_vendors(audit, cfg.top_vendors),
        "surcharge_compliance": surcharge_compliance(clean),
        "audit_leakage": audit_leakage(clean, cfg.top_leakage),
        "yellow_green_volume": volume_by_quarter(clean),
        "velocity_heatmap": velocity_heatmap(clean),
        "tip_vs_surcharge": tip_vs_surcharge(clean),
        "border_effect": border_effect(clean),
        # ``month`` is a partition column equal to month(pickup_time): the
        # extra filter prunes the scan to January-March directories.
        "q1_comparison": q1_comparison(clean.filter(F.col("month") <= 3)),
    }


def weather_reports(daily: DataFrame, weather: DataFrame, cfg: AuditConfig = DEFAULT) -> dict[str, DataFrame]:
    """The rain reports of daily trips (``daily_trips`` of the clean ones, or ``merged_daily``)."""
    joined = rain_join(daily, in_year(weather, cfg.weather_year))
    return {"weather_elasticity": joined, "rain_correlation": rain_elasticity(joined), "rain_trend": rain_trend(joined)}


def run_audit(spark: SparkSession, raw_dir: str | None, out_dir: str,
              cfg: AuditConfig = DEFAULT, weather: DataFrame | None = None,
              impute_mode: str = "exact", fleets=None, report_threads: int = 4,
              intake: DataFrame | None = None, keep_staged: bool = False,
              skip_failed_fleets: bool = False, skip_failed_reports: bool = False,
              ignore_corrupt_files: bool = False, quarantine_files: bool = False,
              store: str | None = None, batch_bytes: int = BATCH_BYTES,
              history: Mapping[str, int] | None = None) -> AuditResult:
    """Intake -> staged batches and partials -> imputation -> audit sink and reports.

    Starts from the raw files, or from ``intake`` (``read_intake`` of a streamed table; then
    ``raw_dir`` or ``history`` only answer for a history month without trips).
    ``weather`` is a daily series ``date, precipitation`` (see ``weather_rows`` /
    ``load_weather``).  The staged table is deleted at the end unless ``keep_staged``; the
    frames of the result then read the written reports.  Given ``store``, a folder of a shared
    file system, batches stay there: the next run with it stages new and changed files only."""
    res = AuditResult(corrupt_files_ignored=ignore_corrupt_files)
    if intake is not None:
        trips, done = stage_intake(spark, intake, cfg, impute_mode, raw_dir, history)
    else:
        done = stage_audit(spark, raw_dir, cfg, impute_mode, fleets, store, skip_failed_fleets,
                           ignore_corrupt_files, quarantine_files, batch_bytes)
        if done is None:
            return res
        res.skipped_fleets, res.quarantined, res.reused_batches = done.skipped_fleets, done.quarantined, done.reused
        if not done.path:
            return res
        trips = done.trips()
    res.imputation, res.ids_lost = done.plan, done.counts["ids_lost"]
    keep = keep_staged or store is not None
    try:
        _report(spark, trips, done, out_dir, cfg, weather, report_threads, skip_failed_reports, keep, res)
    finally:
        if keep:
            res.staged_path = done.path or None
        else:
            delete_path(spark, done.store.root)
    return res


def _report(spark, trips, done, out_dir, cfg, weather, report_threads, skip_failed_reports, keep_staged, res):
    # A selective read: rebalanced, so that the sink's files follow its bytes and not the
    # number of input splits and months behind it.
    res.audit_path = write_parquet(
        trips.filter(F.col("status") == "audit").drop("is_ghost", "inside_zone", "status", "year", "month"),
        f"{out_dir}/audit/ghost_trips_audit", sized=True)
    plan, states = done.plan, done.partials()
    reports = merged_reports(states, cfg) | {
        "row_accounting": observed_accounting(spark, done.counts),
        "imputation": spark.createDataFrame(
            [tuple(plan)], "n_base_old bigint, n_base_new bigint, n_target bigint, target bigint, "
                           "fraction double, action string"),
        "quarantine": spark.createDataFrame(sorted(done.quarantined.items()), "path string, reason string"),
    }
    if weather is not None:
        res.unread_weather_days = unread_days(weather).first()[0]
        reports |= weather_reports(merged_daily(states), weather, cfg)
    reports["intake_losses"] = spark.createDataFrame(
        [(res.ids_lost, res.unread_weather_days, res.corrupt_files_ignored, ",".join(sorted(res.skipped_fleets)),
          len(res.quarantined))],
        "ids_set_null bigint, weather_days_unread bigint, corrupt_files_ignored boolean, fleets_left_out string, "
        "files_left_out bigint")

    # Reports are independent small jobs over the staged table; submitting
    # them from a few threads lets the scheduler run them side by side.
    def write(item):
        name, df = item
        try:
            return name, df, write_csv(df, f"{out_dir}/aggregated/{name}", single_file=True), None
        except Exception as exc:
            return name, df, None, exc

    # Worker threads inherit the caller's local properties (job group,
    # scheduler pool, description).
    with ThreadPoolExecutor(max_workers=report_threads) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(write), reports.items()))
    for name, df, path, exc in results:
        if exc is not None:
            if not skip_failed_reports:
                raise exc
            log.warning("report %s failed: %s", name, exc)
            res.failed_reports[name] = str(exc)
            continue
        res.reports[name] = path
        res.frames[name] = df if keep_staged else read_csv(spark, path, df.schema)


def preview(res: AuditResult) -> None:
    """Show the small reports and the layout of the audited trips."""
    for name in PREVIEWED:
        if name in res.frames:
            print(name)
            res.frames[name].show(20, truncate=False)
    if res.audit_path:
        spark = next(iter(res.frames.values())).sparkSession
        spark.read.parquet(res.audit_path).printSchema()

"""Registered queries over the shared test tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and runs over whole tables.
Report queries round averages and ratios to ``DIGITS`` decimals (the same
rounding is applied by the SQL oracle), and name every computed column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripaudit.config import AuditConfig
from tripaudit.operators import (
    audit_leakage,
    border_effect,
    daily_trips,
    derive_metrics,
    ghost_vendors,
    impute_counts,
    impute_month,
    mark_zone,
    mark_zone_table,
    merged_accounting,
    merged_daily,
    merged_reports,
    period_summary,
    q1_comparison,
    rain_elasticity,
    rain_join,
    rain_trend,
    row_accounting,
    split_ghosts,
    surcharge_compliance,
    tip_series,
    tip_vs_surcharge,
    velocity_heatmap,
    velocity_pivot,
    volume_by_quarter,
    volume_by_year,
)
from tripaudit.schema import UNIFIED_COLUMNS, FleetSpec, ids_lost, unify_schema
from tripaudit.session import list_names, open_files, rename_path, scratch_path
from tripaudit.sources import (
    check_files,
    file_report,
    filter_links,
    harvest_links,
    in_year,
    load_trips,
    new_links,
    overlaid_links,
    plan_files,
    read_csv,
    read_fleet,
    read_group,
    read_taken,
    source_counts,
    take_in,
    union_fleets,
    upsert_stream,
    weather_rows,
    write_csv,
    write_parquet,
)
from tripaudit.sources.tables import (
    LINEITEM_FLEET,
    ORDERS_FLEET,
    TABLE_FLEETS,
    events_trips,
    lineitem_trips,
    orders_trips,
    pages,
    ride_rows,
    table,
    weather_feed,
)

DIGITS = 6

# Orders span 1995-01 .. 2001-08, so December 2001 is missing and is
# imputed from December 2000 (weight 0.7) and December 1999 (weight 0.3).
ORDERS_CFG = AuditConfig(impute_year=2001, impute_month=12)
# December 2000 from December 1999: 29 February 2000 lies between.  The month is there, and
# the threshold lets it be topped up at any scale.
LEAP_CFG = AuditConfig(impute_year=2000, impute_month=12, present_threshold=1_000_000_000_000)
WEATHER_YEAR = 1997

# Link-filter parameters for the crawl (test hrefs are "/word" paths).
LINK_SUFFIX = "."
LINK_YEARS = ("th", "an", "er")
LINK_FLEETS = ("e", "o", "a")
OVERLAY_YEARS = ("ou", "ei")
OVERLAY_FLEETS = ("u", "e")
OVERLAY_TOKEN = "ou"
EXISTING_SECTION = "/fr/"

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), DIGITS) for c in cols})


# --- fleets, schema, union -------------------------------------------------

def q_source_counts(spark, d):
    return source_counts(load_trips(spark, d, fleets=TABLE_FLEETS))


def q_monthly_sources(spark, d):
    """Both fleets written as one folder per month and read back through the glob, with a
    third fleet that has no rows."""
    root = scratch_path(spark, "monthly")
    monthly = []
    for spec in TABLE_FLEETS:
        raw = read_fleet(spark, d, spec)
        folder = f"{spec.name}_tripdata"
        raw.withColumn(folder, F.date_format(spec.columns["pickup_time"], "yyyy-MM")) \
            .write.partitionBy(folder).parquet(f"{root}/{spec.name}")
        monthly.append(FleetSpec(spec.name, spec.columns, "part-*.parquet", f"{spec.name}/{folder}=*"))
    read_fleet(spark, d, ORDERS_FLEET).limit(0).write.parquet(f"{root}/empty/empty_tripdata=none")
    monthly.append(FleetSpec("empty", ORDERS_FLEET.columns, "part-*.parquet", "empty/empty_tripdata=*"))
    return source_counts(load_trips(spark, root, fleets=monthly))


def q_unify_schema(spark, d):
    return unify_schema(read_fleet(spark, d, LINEITEM_FLEET), LINEITEM_FLEET)


def q_union_fleets(spark, d):
    return load_trips(spark, d, fleets=TABLE_FLEETS)


# --- calendar over orders --------------------------------------------------

def q_period_summary(spark, d):
    return period_summary(orders_trips(spark, d))


def q_impute_counts(spark, d):
    return rounded(impute_counts(orders_trips(spark, d), ORDERS_CFG), "fraction")


def q_impute_month(spark, d):
    return impute_month(orders_trips(spark, d), ORDERS_CFG, mode="exact")


def q_impute_month_leap(spark, d):
    return impute_month(orders_trips(spark, d), LEAP_CFG, mode="exact")


def q_impute_month_sampled(spark, d):
    return impute_month(orders_trips(spark, d), ORDERS_CFG, mode="sampled")


def q_volume_by_quarter(spark, d):
    return volume_by_quarter(orders_trips(spark, d))


def q_volume_by_year(spark, d):
    return volume_by_year(volume_by_quarter(orders_trips(spark, d)))


def q_q1_comparison(spark, d):
    return q1_comparison(orders_trips(spark, d))


def q_daily_trips(spark, d):
    return daily_trips(orders_trips(spark, d))


# --- ghost split over events ----------------------------------------------

def _split(spark, d):
    return split_ghosts(events_trips(spark, d))


def _marked_clean(spark, d):
    return mark_zone(_split(spark, d).clean)


def q_trip_metrics(spark, d):
    return derive_metrics(events_trips(spark, d)).select(
        "event_id", "pickup_time", "dropoff_time", "trip_distance",
        "duration_seconds", "duration_hours", "speed_mph")


def q_ghost_clean(spark, d):
    return _split(spark, d).clean


def q_ghost_audit(spark, d):
    return _split(spark, d).audit


def q_ghost_undetermined(spark, d):
    return _split(spark, d).undetermined


def q_row_accounting(spark, d):
    return row_accounting(events_trips(spark, d))


def q_ghost_vendors(spark, d):
    return ghost_vendors(_split(spark, d).audit)


def q_mark_zone(spark, d):
    return _marked_clean(spark, d).select("event_id", "dropoff_loc", "inside_zone")


def q_mark_zone_table(spark, d):
    """Drop-offs marked from a table of zones: the suppliers of the first twelve nations."""
    zones = table(spark, d, "supplier").filter(F.col("s_nationkey") < 12).select(F.col("s_suppkey").alias("LocationID"))
    return mark_zone_table(_split(spark, d).clean, zones).select("event_id", "dropoff_loc", "inside_zone")


def q_surcharge_compliance(spark, d):
    return surcharge_compliance(_marked_clean(spark, d))


def q_audit_leakage(spark, d):
    return audit_leakage(_marked_clean(spark, d))


def q_velocity_heatmap(spark, d):
    return rounded(velocity_heatmap(_marked_clean(spark, d)), "avg_speed")


def q_velocity_pivot(spark, d):
    return velocity_pivot(q_velocity_heatmap(spark, d))


def q_border_effect(spark, d):
    return border_effect(_split(spark, d).clean)


# --- money over lineitem ---------------------------------------------------

def q_tip_vs_surcharge(spark, d):
    return rounded(tip_vs_surcharge(lineitem_trips(spark, d)), "avg_surcharge", "avg_tip_amount")


def q_tip_series(spark, d):
    return tip_series(q_tip_vs_surcharge(spark, d))


# --- weather ---------------------------------------------------------------

def q_weather_rows(spark, d):
    return rounded(weather_rows(weather_feed(spark, d)), "precipitation")


def _rain(spark, d):
    return rain_join(daily_trips(orders_trips(spark, d)), weather_rows(weather_feed(spark, d)))


def q_rain_join(spark, d):
    return rounded(_rain(spark, d), "precipitation")


def q_rain_join_year(spark, d):
    weather = in_year(weather_rows(weather_feed(spark, d)), WEATHER_YEAR)
    return rounded(rain_join(daily_trips(orders_trips(spark, d)), weather), "precipitation")


def q_rain_elasticity(spark, d):
    return rounded(rain_elasticity(_rain(spark, d)), "correlation")


def q_rain_trend(spark, d):
    return rounded(rain_trend(_rain(spark, d)), "slope", "intercept", "r2")


# --- links and intake ------------------------------------------------------

def q_link_harvest(spark, d):
    return harvest_links(pages(spark, d))


def _link_map(spark, d):
    return filter_links(harvest_links(pages(spark, d)), LINK_YEARS, LINK_FLEETS, LINK_SUFFIX)


def q_link_filter(spark, d):
    return _link_map(spark, d)


def q_link_overlay(spark, d):
    return overlaid_links(harvest_links(pages(spark, d)), (LINK_YEARS, LINK_FLEETS),
                          (OVERLAY_YEARS, OVERLAY_FLEETS), OVERLAY_TOKEN, LINK_SUFFIX)


def q_intake_new(spark, d):
    crawled = pages(spark, d).withColumn("taken", F.col("url").contains(EXISTING_SECTION))
    return new_links(harvest_links(crawled, keep=("taken",)), F.col("taken"),
                     LINK_YEARS, LINK_FLEETS, LINK_SUFFIX)


# --- sinks and read-back ---------------------------------------------------

def q_parquet_roundtrip(spark, d):
    path = write_parquet(_split(spark, d).audit, scratch_path(spark, "audit"))
    return spark.read.parquet(path)


Q1_CSV_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("taxi_type", T.StringType()),
    T.StructField("count", T.LongType()),
])


def q_csv_roundtrip(spark, d):
    path = write_csv(q1_comparison(orders_trips(spark, d)), scratch_path(spark, "q1csv"))
    return read_csv(spark, path, Q1_CSV_SCHEMA)


# --- the whole audit over two table-backed fleets --------------------------

AUDIT_CFG = ORDERS_CFG.with_(fleets=TABLE_FLEETS)


def q_audit_accounting(spark, d):
    from tripaudit.plans.audit_run import stage_audit, staged_accounting

    return staged_accounting(stage_audit(spark, d, AUDIT_CFG).trips())


def q_audit_observed(spark, d):
    """Accounting and imputation counts as the staging writes observed them."""
    from tripaudit.plans.audit_run import observed_accounting, stage_audit

    done = stage_audit(spark, d, AUDIT_CFG)
    return observed_accounting(spark, done.counts).withColumns(
        {k: F.lit(getattr(done.plan, k)).cast("bigint") for k in ("n_base_old", "n_base_new", "n_target", "target")}
        | {"action": F.lit(done.plan.action), "ids_lost": F.lit(done.counts["ids_lost"]).cast("bigint")})


def _audit_report(name: str, *digits: str) -> Query:
    """A report of the whole run over trips of ``events``, landed as one fleet's files."""
    def query(spark, d):
        from tripaudit.plans.audit_run import stage_audit

        root = scratch_path(spark, "events-fleet")
        events_trips(spark, d).select(*UNIFIED_COLUMNS).drop("taxi_type").write.parquet(f"{root}/events")
        done = stage_audit(spark, root, ORDERS_CFG, fleets=(_own_fleet("events", "events"),))
        return rounded(merged_reports(done.partials(), ORDERS_CFG)[name], *digits)

    return query


def _own_fleet(name: str, folder: str) -> FleetSpec:
    """A fleet whose files hold the unified columns."""
    return FleetSpec(name, {c: c for c in UNIFIED_COLUMNS if c != "taxi_type"}, "part-*", folder)


AUDIT_REPORTS = {
    "audit_ghost_vendors": _audit_report("ghost_vendors"),
    "audit_compliance": _audit_report("surcharge_compliance"),
    "audit_run_leakage": _audit_report("audit_leakage"),
    "audit_heatmap": _audit_report("velocity_heatmap", "avg_speed"),
    "audit_q1": _audit_report("q1_comparison"),
}

# --- the run over two fleets of several years: partials, batches, files -----

RIDE_FLEETS = ("rides_n", "rides_r")
#: Landings of the rides: years up to 1997, then the others.
FIRST_YEARS = 1997


def _land_rides(spark, d, root: str, when=None) -> None:
    """Write the rides as raw files, one folder per fleet and year of pick-up."""
    rides = ride_rows(spark, d)
    (rides.filter(when) if when is not None else rides) \
        .withColumn("landed", F.year("pickup_time")) \
        .write.mode("append").partitionBy("taxi_type", "landed").parquet(root)


def _ride_fleets() -> tuple[FleetSpec, ...]:
    return tuple(_own_fleet(name, f"taxi_type={name}/landed=*") for name in RIDE_FLEETS)


def _staged_rides(spark, d):
    from tripaudit.plans.audit_run import stage_audit

    root = scratch_path(spark, "rides")
    _land_rides(spark, d, root)
    return stage_audit(spark, root, ORDERS_CFG, fleets=_ride_fleets())


def _run_report(name: str, *digits: str) -> Query:
    """A report merged from the partials of the staged rides, imputed month included."""
    def query(spark, d):
        return rounded(merged_reports(_staged_rides(spark, d).partials(), ORDERS_CFG)[name], *digits)

    return query


def _run_weather(name: str, *digits: str) -> Query:
    """A rain report merged from the partials of the staged rides."""
    def query(spark, d):
        from tripaudit.plans.audit_run import weather_reports

        daily = merged_daily(_staged_rides(spark, d).partials())
        return rounded(weather_reports(daily, weather_rows(weather_feed(spark, d)), ORDERS_CFG)[name], *digits)

    return query


def q_run_incremental(spark, d):
    """Accounting of a store that was filled by two landings: the second run finds the first
    run's batches and adds partials of the new files only."""
    from tripaudit.plans.audit_run import stage_audit

    root, store = scratch_path(spark, "rides"), scratch_path(spark, "store")
    early = F.year("pickup_time") <= FIRST_YEARS
    _land_rides(spark, d, root, early)
    first = stage_audit(spark, root, ORDERS_CFG, fleets=_ride_fleets(), path=store)
    _land_rides(spark, d, root, ~early)
    second = stage_audit(spark, root, ORDERS_CFG, fleets=_ride_fleets(), path=store)
    return merged_accounting(second.partials()).withColumn(
        "batches_reused", F.lit(len(set(first.batches) & set(second.reused))))


def q_run_compacted(spark, d):
    """Audited trips of a store that two landings filled, after its batches became one per
    fleet; the last run finds the compacted batches and stages nothing."""
    from tripaudit.plans.audit_run import stage_audit

    root, store = scratch_path(spark, "rides"), scratch_path(spark, "store")
    early = F.year("pickup_time") <= FIRST_YEARS
    for landing in (early, ~early):
        _land_rides(spark, d, root, landing)
        done = stage_audit(spark, root, ORDERS_CFG, fleets=_ride_fleets(), path=store)
    made = done.store.compact()
    again = stage_audit(spark, root, ORDERS_CFG, fleets=_ride_fleets(), path=store)
    return (again.trips().filter(F.col("status") == "audit").select(*UNIFIED_COLUMNS, "is_imputed")
            .withColumn("batches_reused", F.lit(len({b.name for b in made} & set(again.reused)))))


DRIFT_FLEET = FleetSpec("lineitem", LINEITEM_FLEET.columns, "part-*", "ids=*")


def _land_drift(spark, d) -> str:
    """Line items as files that hold their ids as INT, BIGINT, DOUBLE (some with a fraction)
    and text (some no number)."""
    root = scratch_path(spark, "drift")
    li = table(spark, d, "lineitem")
    ids = ("l_suppkey", "l_partkey", "l_linenumber")
    rest = [c for c in LINEITEM_FLEET.columns.values() if c not in ids]
    key = F.col("l_orderkey")
    forms = (
        [F.col(c).cast("int").alias(c) for c in ids],
        [F.col(c).cast("bigint").alias(c) for c in ids],
        [(F.col(c).cast("double") + F.when(key % 10 == 0, 0.5).otherwise(0.0)).alias(c) for c in ids],
        [F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c) for c in ids])
    for i, form in enumerate(forms):
        li.filter(key % 4 == i).select(*form, *rest).write.parquet(f"{root}/ids={i}")
    return root


def _drifted(spark, d):
    root = _land_drift(spark, d)
    return plan_files(check_files(spark, root, DRIFT_FLEET), DRIFT_FLEET).groups


def q_drift_trips(spark, d):
    """Trips of files whose ids changed their physical type three times."""
    return union_fleets(unify_schema(read_group(spark, schema, files), DRIFT_FLEET)
                        for schema, files in _drifted(spark, d))


def q_drift_losses(spark, d):
    """Rows, read schemas and ids that did not fit, over the same files."""
    groups = _drifted(spark, d)
    raw = [read_group(spark, schema, files) for schema, files in groups]
    counted = union_fleets(r.agg(F.count(F.lit(1)).alias("n"), ids_lost(r, DRIFT_FLEET).alias("lost")) for r in raw)
    return counted.agg(F.sum("n").alias("trips"), F.sum("lost").alias("ids_lost")).withColumn(
        "read_schemas", F.lit(len(groups)))


PIECES = 4


def _land_pieces(spark, d) -> str:
    """Orders in four folders; the customer ids of the last are booleans.  A fifth holds text."""
    root = scratch_path(spark, "pieces")
    orders = table(spark, d, "orders").withColumn("piece", F.col("o_orderkey") % PIECES)
    last = F.col("piece") == PIECES - 1
    orders.filter(~last).write.partitionBy("piece").parquet(f"{root}/orders")
    orders.filter(last).withColumn("o_custkey", F.col("o_custkey") > 0).drop("piece") \
        .write.parquet(f"{root}/orders/piece={PIECES - 1}")
    orders.select("o_orderpriority").write.text(f"{root}/orders/piece={PIECES}")
    return root


PIECES_FLEET = FleetSpec("orders", ORDERS_FLEET.columns, "part-*", "orders/piece=*")


def q_quarantine_kept(spark, d):
    """Staged trips of the files that can be read, with two folders of bad files beside them."""
    from tripaudit.plans.audit_run import stage_audit

    done = stage_audit(spark, _land_pieces(spark, d), ORDERS_CFG, fleets=(PIECES_FLEET,), quarantine_files=True)
    return done.trips().filter(~F.col("is_imputed")).select(*UNIFIED_COLUMNS)


def q_quarantine_files(spark, d):
    """What the footers say of every folder: rows, and whether its files are left out."""
    files = check_files(spark, _land_pieces(spark, d), PIECES_FLEET)
    report = file_report(spark, [plan_files(files, PIECES_FLEET)], {"orders": files})
    return report.groupBy(F.regexp_extract("path", r"piece=(\d+)", 1).cast("int").alias("piece")).agg(
        F.sum("rows").alias("trips"), F.bool_and(F.col("error").isNotNull()).alias("left_out"))


def _land_years(spark, rides: DataFrame, root: str) -> None:
    """Write rides as one raw file per year of pick-up, named as monthly files are."""
    made = scratch_path(spark, "years")
    with open_files(spark):
        rides.withColumn("landed", F.year("pickup_time")).repartition("landed").write.partitionBy("landed").parquet(made)
    for folder in list_names(spark, made):
        for part in list_names(spark, f"{made}/{folder}"):
            if part.startswith("part-"):
                rename_path(spark, f"{made}/{folder}/{part}", f"{root}/rides_tripdata_{folder.removeprefix('landed=')}.parquet")


UPSERT_FLEET = FleetSpec("rides", {c: c for c in UNIFIED_COLUMNS if c != "taxi_type"}, "rides_tripdata_*.parquet")
#: The year that lands again with other fares, and the one that lands again as it was.
CHANGED_YEAR, MOVED_YEAR = 1996, 1997


def q_intake_upsert(spark, d):
    """Trips by landed file after two landings, taken in as a batch and as a stream: one year
    landed again with other fares, one as it was, some are new."""
    raw, batch, streamed, ck = (scratch_path(spark, n) for n in ("raw", "batch", "stream", "stream-ck"))
    rides = ride_rows(spark, d)
    year = F.year("pickup_time")
    early = year <= FIRST_YEARS
    landings = (
        rides.filter(early),
        rides.filter(~early | year.isin(CHANGED_YEAR, MOVED_YEAR))
             .withColumn("fare", F.when(year == CHANGED_YEAR, F.col("fare") * 2).otherwise(F.col("fare"))))
    for i, landing in enumerate(landings):
        _land_years(spark, landing, f"{raw}/landing-{i}")
        take_in(spark, raw, batch, UPSERT_FLEET)
        upsert_stream(spark, raw, streamed, UPSERT_FLEET, checkpoint=ck).awaitTermination()

    def told(out: str, way: str) -> DataFrame:
        return read_taken(spark, out).groupBy("landed").agg(
            F.count(F.lit(1)).alias(f"{way}_trips"), F.round(F.sum("fare"), 3).alias(f"{way}_fares"))

    return told(batch, "batch").join(told(streamed, "stream"), "landed", "full")


def q_parquet_sized(spark, d):
    """Audited trips of several hundred input splits through the size-targeted sink."""
    path = write_parquet(_split(spark, d).audit.repartition(300), scratch_path(spark, "audit"), sized=True)
    return spark.read.parquet(path)


RUN_REPORTS = {
    "run_source_counts": _run_report("source_counts"),
    "run_period_summary": _run_report("period_summary"),
    "run_volume": _run_report("yellow_green_volume"),
    "run_tips": _run_report("tip_vs_surcharge", "avg_surcharge", "avg_tip_amount"),
    "run_border": _run_report("border_effect"),
    "run_heatmap": _run_report("velocity_heatmap", "avg_speed"),
    "run_rain_days": _run_weather("weather_elasticity", "precipitation"),
    "run_rain_correlation": _run_weather("rain_correlation", "correlation"),
    "run_rain_trend": _run_weather("rain_trend", "slope", "intercept", "r2"),
    "run_incremental": q_run_incremental,
    "run_compacted": q_run_compacted,
}


QUERIES: dict[str, Query] = {
    "source_counts": q_source_counts,
    "monthly_sources": q_monthly_sources,
    "unify_schema": q_unify_schema,
    "union_fleets": q_union_fleets,
    "period_summary": q_period_summary,
    "impute_counts": q_impute_counts,
    "impute_month": q_impute_month,
    "impute_month_leap": q_impute_month_leap,
    "impute_month_sampled": q_impute_month_sampled,
    "trip_metrics": q_trip_metrics,
    "ghost_clean": q_ghost_clean,
    "ghost_audit": q_ghost_audit,
    "ghost_undetermined": q_ghost_undetermined,
    "row_accounting": q_row_accounting,
    "ghost_vendors": q_ghost_vendors,
    "mark_zone": q_mark_zone,
    "mark_zone_table": q_mark_zone_table,
    "surcharge_compliance": q_surcharge_compliance,
    "audit_leakage": q_audit_leakage,
    "volume_by_quarter": q_volume_by_quarter,
    "volume_by_year": q_volume_by_year,
    "velocity_heatmap": q_velocity_heatmap,
    "velocity_pivot": q_velocity_pivot,
    "tip_vs_surcharge": q_tip_vs_surcharge,
    "tip_series": q_tip_series,
    "border_effect": q_border_effect,
    "q1_comparison": q_q1_comparison,
    "daily_trips": q_daily_trips,
    "weather_rows": q_weather_rows,
    "rain_join": q_rain_join,
    "rain_join_year": q_rain_join_year,
    "rain_elasticity": q_rain_elasticity,
    "rain_trend": q_rain_trend,
    "link_harvest": q_link_harvest,
    "link_filter": q_link_filter,
    "link_overlay": q_link_overlay,
    "intake_new": q_intake_new,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "audit_accounting": q_audit_accounting,
    "audit_observed": q_audit_observed,
    **AUDIT_REPORTS,
    **RUN_REPORTS,
    "drift_trips": q_drift_trips,
    "drift_losses": q_drift_losses,
    "quarantine_kept": q_quarantine_kept,
    "quarantine_files": q_quarantine_files,
    "intake_upsert": q_intake_upsert,
    "parquet_sized": q_parquet_sized,
}

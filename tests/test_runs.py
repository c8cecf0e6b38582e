"""Whole audit run and streaming intake, end to end on small inputs."""

import contextlib
import datetime as dt
import io
import os

import pyarrow as pa
import pyarrow.parquet as pq
from conftest import SF0001

from pyspark.sql import functions as F

from tripaudit.config import AuditConfig
from tripaudit.plans.audit_run import audit_reports, run_audit
from tripaudit.sources import weather_rows
from tripaudit.sources.tables import TABLE_FLEETS, weather_feed
from tripaudit.streaming import read_history, read_intake, record_history, start_intake


def test_run_audit_on_test_tables(spark, tmp_dir):
    cfg = AuditConfig(impute_year=2001, impute_month=12, fleets=TABLE_FLEETS)
    res = run_audit(spark, SF0001, tmp_dir, cfg, weather=weather_rows(weather_feed(spark, SF0001)),
                    keep_staged=True)
    assert res.complete and res.imputation.action == "impute" and res.ids_lost == 0
    acc = res.frames["row_accounting"].first()
    assert acc.total == acc.clean + acc.audit + acc.undetermined
    staged = spark.read.parquet(res.staged_path)
    # accounting observed during the staging write equals a recount of the table
    assert acc.total == staged.count()
    assert not res.reused_batches and not res.quarantined
    assert acc.audit == staged.filter("is_ghost").count()
    assert acc.undetermined == staged.filter("is_ghost is null").count()
    assert staged.filter("is_imputed").count() > 0
    assert staged.filter("not is_imputed").count() == 1500 + 6000
    assert os.path.isdir(res.audit_path)
    def explained(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()

    # the run's reports are merged from partials: no trip is read again
    for name in ("q1_comparison", "period_summary", "ghost_vendors", "weather_elasticity"):
        assert "/partials/batch=" in explained(res.frames[name]) and "/trips/" not in explained(res.frames[name]), name
    assert sorted(res.frames["period_summary"].collect()) == sorted(
        staged.filter("not is_imputed").groupBy(F.year("pickup_time").alias("year"),
                                                F.month("pickup_time").alias("month"))
        .count().collect())
    # straight from the trips, each report prunes: to the clean or audit partitions, to months,
    # and the period summary reads partition values only
    direct = audit_reports(staged, cfg)
    plan = explained(direct["q1_comparison"])
    assert "PartitionFilters: [isnotnull(status" in plan and "(status#" in plan
    assert "(month#" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert "pickup_time" not in explained(direct["period_summary"]).split("ReadSchema:")[1].split("\n")[0]
    pf = explained(direct["ghost_vendors"]).split("PartitionFilters:")[1].split("\n")[0]
    assert "status" in pf and "audit" in pf
    for name in ("q1_comparison", "velocity_heatmap", "weather_elasticity", "rain_trend"):
        assert name in res.reports and os.path.isdir(res.reports[name])


def _yellow_file(path, start, n, id_type=pa.int64()):
    t = dt.datetime(2024, 3, 1, 9, 0) + dt.timedelta(hours=start)
    pq.write_table(pa.table({
        "tpep_pickup_datetime": pa.array([t] * n, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([t + dt.timedelta(minutes=10)] * n, pa.timestamp("us")),
        "PULocationID": pa.array(list(range(start, start + n)), id_type),
        "DOLocationID": pa.array([4] * n, id_type),
        "trip_distance": pa.array([2.0] * n, pa.float64()),
        "fare_amount": pa.array([10.0] * n, pa.float64()),
        "total_amount": pa.array([14.0] * n, pa.float64()),
        "congestion_surcharge": pa.array([2.5] * n, pa.float64()),
    }), path)


def test_streaming_intake_takes_new_files_once(spark, tmp_dir):
    raw, out, ck = (os.path.join(tmp_dir, d) for d in ("raw", "out", "ck"))
    os.makedirs(raw)
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-03.parquet"), 0, 3)
    for q in start_intake(spark, raw, out, fleets=("yellow",), checkpoint=ck):
        q.awaitTermination(120)
        batches = [p for p in q.recentProgress if p["numInputRows"]]
        acc = batches[-1]["observedMetrics"]["accounting"]
        assert (acc["total"], acc["clean"]) == (3, 3)
    assert spark.read.parquet(out).count() == 3
    # the second month stores ids as INT32: the widened read schema absorbs it
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-04.parquet"), 10, 2, pa.int32())
    for q in start_intake(spark, raw, out, fleets=("yellow",), checkpoint=ck):
        q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 5
    assert df.filter("inside_zone and not is_ghost").count() == 5
    # same layout as the staged table of the batch run
    assert os.path.isdir(os.path.join(out, "taxi_type=yellow", "status=clean", "year=2024", "month=3"))


def test_command_line_run(spark, tmp_dir):
    from tripaudit.__main__ import main

    raw, out, wdir = (os.path.join(tmp_dir, d) for d in ("raw", "out", "weather"))
    os.makedirs(raw)
    os.makedirs(wdir)
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-03.parquet"), 0, 4)
    with open(os.path.join(wdir, "2024.json"), "w") as f:
        f.write('{"daily":{"time":["2024-03-01","2024-03-02"],"precipitation_sum":[1.5,0.0]}}')
    assert main(["--raw", raw, "--out", out, "--weather", os.path.join(wdir, "*.json")]) == 0
    assert main(["audit", "--raw", raw, "--out", out + "2"]) == 0
    joined = spark.read.option("header", True).csv(os.path.join(out, "aggregated", "weather_elasticity"))
    assert [(r.date, r.total_trips, r.precipitation) for r in joined.collect()] == [("2024-03-01", "4", "1.5")]


def test_dashboard_read_path(spark, tmp_dir):
    from tripaudit.plans.dashboard import load_dashboard

    cfg = AuditConfig(impute_year=2001, impute_month=12, fleets=TABLE_FLEETS)
    res = run_audit(spark, SF0001, tmp_dir, cfg, weather=weather_rows(weather_feed(spark, SF0001)))
    dash, failed = load_dashboard(spark, tmp_dir)
    assert not failed
    assert {"volume_by_year", "velocity_pivot", "tip_series", "rain_correlation", "rain_trend"} <= set(dash)
    assert dash["volume_by_year"].agg({"count": "sum"}).first()[0] == \
        res.frames["yellow_green_volume"].agg({"count": "sum"}).first()[0]
    r1 = dash["rain_correlation"].first()
    r2 = res.frames["rain_correlation"].first()
    assert r1.n == r2.n
    assert (r1.correlation is None) == (r2.correlation is None)
    if r1.correlation is not None:
        assert abs(r1.correlation - r2.correlation) < 1e-9


def test_missing_or_different_reports_raise_or_are_listed(spark, tmp_dir):
    import pytest

    from tripaudit.plans.dashboard import REPORT_SCHEMAS, load_dashboard
    from tripaudit.sources import write_csv

    tips = spark.createDataFrame([(2024, 1, 2.5, 4.0)], REPORT_SCHEMAS["tip_vs_surcharge"])
    write_csv(tips, os.path.join(tmp_dir, "aggregated", "tip_vs_surcharge"))
    write_csv(tips, os.path.join(tmp_dir, "aggregated", "q1_comparison"))  # another report's columns
    with pytest.raises(Exception, match="yellow_green_volume|PATH_NOT_FOUND"):
        load_dashboard(spark, tmp_dir)
    frames, failed = load_dashboard(spark, tmp_dir, skip_failed=True)
    assert set(frames) == {"tip_vs_surcharge", "tip_series"}
    assert set(failed) == set(REPORT_SCHEMAS) - {"tip_vs_surcharge"}
    assert "avg_surcharge" in failed["q1_comparison"]
    assert [tuple(r) for r in frames["tip_vs_surcharge"].collect()] == [(2024, 1, 2.5, 4.0)]


def test_command_line_links_and_intake(spark, tmp_dir, capsys):
    from tripaudit.__main__ import main

    pages = os.path.join(tmp_dir, "pages")
    os.makedirs(pages)
    with open(os.path.join(pages, "a.html"), "w") as f:
        f.write('<a href="https://x/old/yellow_tripdata_2024-01.parquet">1</a>'
                '<a href="https://x/green_tripdata_2023-12.parquet">2</a>'
                '<a href="https://x/green_tripdata_2023-11.parquet">3</a>')
    with open(os.path.join(pages, "b.html"), "w") as f:
        f.write('<a href="https://x/new/yellow_tripdata_2024-01.parquet">1</a>')
    assert main(["links", "--pages", os.path.join(pages, "*.html"), "--years", "2024",
                 "--month-token", "_2023-12", "--month-years", "2023"]) == 0
    lines = capsys.readouterr().out.strip().splitlines()
    assert lines == ["green_tripdata_2023-12.parquet\thttps://x/green_tripdata_2023-12.parquet",
                     "yellow_tripdata_2024-01.parquet\thttps://x/new/yellow_tripdata_2024-01.parquet"]
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "table")
    os.makedirs(raw)
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-03.parquet"), 0, 2)
    assert main(["intake", "--raw", raw, "--out", out, "--fleets", "yellow",
                 "--checkpoint", os.path.join(tmp_dir, "ck")]) == 0
    assert spark.read.parquet(out).count() == 2


def test_staged_table_is_deleted_and_frames_stay_readable(spark, tmp_dir):
    from tripaudit.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark)
    before = set(os.listdir(root.removeprefix("file:")))
    cfg = AuditConfig(impute_year=2001, impute_month=12, fleets=TABLE_FLEETS)
    res = run_audit(spark, SF0001, tmp_dir, cfg)
    left = {x for x in set(os.listdir(root.removeprefix("file:"))) - before if "staged" in x}
    assert res.staged_path is None and not left
    assert res.frames["period_summary"].count() > 0
    assert res.frames["imputation"].first().action == "impute"


def test_audit_from_taken_in_trips_equals_the_audit_of_files(spark, tmp_dir):
    raw, table = (os.path.join(tmp_dir, d) for d in ("raw", "table"))
    os.makedirs(raw)
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-03.parquet"), 0, 5)
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-04.parquet"), 20, 3)
    cfg = AuditConfig(impute_year=2025, impute_month=3, history_weights=(0.0, 1.0), fleets=("yellow",))
    for q in start_intake(spark, raw, table, fleets=("yellow",), checkpoint=os.path.join(tmp_dir, "ck")):
        q.awaitTermination(120)
    # a file that no batch committed does not count
    _yellow_file(os.path.join(table, "taxi_type=yellow", "stray.parquet"), 40, 4)
    files = run_audit(spark, raw, os.path.join(tmp_dir, "a"), cfg)
    taken = run_audit(spark, None, os.path.join(tmp_dir, "b"), cfg, intake=read_intake(spark, table, ("yellow",)))
    assert files.imputation == taken.imputation and taken.imputation.action == "impute"
    for name in ("row_accounting", "period_summary", "velocity_heatmap", "source_counts", "q1_comparison"):
        assert sorted(files.frames[name].collect()) == sorted(taken.frames[name].collect()), name


def test_history_without_trips_counts_in_the_streamed_run_too(spark, tmp_dir):
    """The file of the older history month holds trips of other days: both runs fall back to
    its rows, the streamed one from the intake's own counts, after the file is gone."""
    raw, table = (os.path.join(tmp_dir, d) for d in ("raw", "table"))
    os.makedirs(raw)
    _yellow_file(os.path.join(raw, "yellow_tripdata_2023-03.parquet"), 24 * 200, 40)  # in September 2024
    _yellow_file(os.path.join(raw, "yellow_tripdata_2024-03.parquet"), 0, 10)
    cfg = AuditConfig(impute_year=2025, impute_month=3, fleets=("yellow",))
    for q in start_intake(spark, raw, table, fleets=("yellow",), checkpoint=os.path.join(tmp_dir, "ck")):
        q.awaitTermination(120)
    files = run_audit(spark, raw, os.path.join(tmp_dir, "a"), cfg)
    os.remove(os.path.join(raw, "yellow_tripdata_2023-03.parquet"))
    record_history(spark, raw, table, ("yellow",))  # a later run of the intake keeps what it knew
    taken = run_audit(spark, None, os.path.join(tmp_dir, "b"), cfg, intake=read_intake(spark, table, ("yellow",)),
                      history=read_history(spark, table))
    assert files.imputation == taken.imputation and taken.imputation.target == 19  # 0.3 * 40 + 0.7 * 10
    assert sorted(files.frames["row_accounting"].collect()) == sorted(taken.frames["row_accounting"].collect())
    from tripaudit.__main__ import main

    assert main(["audit", "--intake", table, "--out", os.path.join(tmp_dir, "c"), "--fleets", "yellow", "--quiet",
                 "--impute-year", "2025", "--impute-month", "3"]) == 0
    plan = spark.read.option("header", True).csv(os.path.join(tmp_dir, "c", "aggregated", "imputation")).first()
    assert (plan.n_base_old, plan.target) == ("40", "19")


def test_failed_report_is_raised_or_listed(spark, tmp_dir):
    import pytest

    cfg = AuditConfig(impute_year=2001, impute_month=12, fleets=TABLE_FLEETS)
    bad = spark.range(1).selectExpr("date'2000-01-01' as date", "cast(raise_error('broken') as double) as precipitation")
    with pytest.raises(Exception, match="broken"):
        run_audit(spark, SF0001, tmp_dir, cfg, weather=bad)
    res = run_audit(spark, SF0001, tmp_dir, cfg, weather=bad, skip_failed_reports=True)
    assert not res.complete and "rain_correlation" in res.failed_reports and "q1_comparison" in res.reports


def test_preview_shows_small_reports(spark, tmp_dir, capsys):
    from tripaudit.plans.audit_run import preview

    preview(run_audit(spark, SF0001, tmp_dir, AuditConfig(fleets=TABLE_FLEETS)))
    shown = capsys.readouterr().out
    assert "row_accounting" in shown and "audit_leakage" in shown and " |-- pickup_time" in shown

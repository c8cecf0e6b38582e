"""Imputation: exact size, determinism, chunked expansion, guards."""

import datetime as dt

import pytest
from conftest import SF001
from helpers import trips_df

from pyspark.sql import functions as F

from tripaudit.config import AuditConfig
from tripaudit.operators import exact_sample, impute_counts, impute_month, plan_imputation
from tripaudit.sources.tables import orders_trips

CFG = AuditConfig(impute_year=2025, impute_month=12, present_threshold=3)


def _month_rows(spark, n, dup=1, month="2024-12"):
    rows = []
    for i in range(n):
        for _ in range(dup):
            rows.append(dict(pickup_time=f"{month}-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:00",
                             dropoff_time=f"{month}-{1 + i % 28:02d} {i % 24:02d}:{i % 60:02d}:30",
                             fare=float(i), taxi_type="yellow"))
    return trips_df(spark, rows)


def _copies(df):
    return sorted((r.fare, r.c) for r in df.groupBy("fare").agg(F.count("*").alias("c")).collect())


@pytest.mark.parametrize("target", [0, 1, 7, 20, 33, 95])
def test_exact_size(spark, target):
    base = _month_rows(spark, 20)
    out = exact_sample(base, target, 20)
    assert out.count() == target
    # each row is used floor or ceil of target/n times
    cs = [c for _, c in _copies(out)]
    assert all(target // 20 <= c <= -(-target // 20) for c in cs)


def test_exact_is_deterministic_and_groups_copies(spark):
    base = _month_rows(spark, 10, dup=3)  # 30 rows, groups of 3 copies
    a = _copies(exact_sample(base, 17, 30))
    b = _copies(exact_sample(base.repartition(5), 17, 30))
    assert a == b and sum(c for _, c in a) == 17


def test_chunked_expansion_matches(spark):
    base = _month_rows(spark, 3, dup=50)  # 150 rows, 3 heavy groups
    small = exact_sample(base, 1000, 150, chunk=7)
    big = exact_sample(base, 1000, 150)
    assert small.count() == 1000 and _copies(small) == _copies(big)


def test_shift_keeps_time_of_day(spark):
    base = trips_df(spark, [dict(pickup_time="2024-12-01 13:45:00", dropoff_time="2024-12-01 14:00:00",
                                 taxi_type="yellow")])
    out = impute_month(base, CFG.with_(present_threshold=1000, history_weights=(0.0, 1.0)))
    imp = out.filter("is_imputed").collect()
    assert [r.pickup_time for r in imp] == [dt.datetime(2025, 12, 1, 13, 45)]
    assert [r.dropoff_time for r in imp] == [dt.datetime(2025, 12, 1, 14, 0)]


def test_guards(spark):
    hist = _month_rows(spark, 10)
    # target month present: no-op
    present = hist.unionByName(_month_rows(spark, 5, month="2025-12"))
    p = plan_imputation(present, CFG)
    assert p.action == "present"
    assert impute_month(present, CFG, plan=p).filter("is_imputed").count() == 0
    # no history at all
    empty = _month_rows(spark, 2, month="2025-06")
    assert plan_imputation(empty, CFG).action == "no_history"
    # only the older month: target > 0 but nothing to sample from
    old = _month_rows(spark, 10, month="2023-12")
    assert plan_imputation(old, CFG).action == "empty_base"


def test_sampled_mode_size(spark):
    base = _month_rows(spark, 28, dup=40)  # 1120 rows in Dec 2024
    cfg = CFG.with_(present_threshold=1000, history_weights=(0.0, 0.5))
    n = impute_month(base, cfg, mode="sampled").filter("is_imputed").count()
    assert 400 < n < 720  # Poisson around 560


def test_sampled_rows_do_not_depend_on_the_layout(spark):
    base = _month_rows(spark, 28, dup=20).repartition(1)
    cfg = CFG.with_(present_threshold=1000, history_weights=(0.0, 0.9))
    runs = []
    for df in (base, base.repartition(7), base.repartition(3, "fare").sortWithinPartitions(F.desc("pickup_time"))):
        runs.append(sorted(impute_month(df, cfg, mode="sampled").filter("is_imputed").collect()))
    assert runs[0] == runs[1] == runs[2] and 380 < len(runs[0]) < 630
    other = impute_month(base, cfg.with_(impute_seed=7), mode="sampled").filter("is_imputed").collect()
    assert sorted(other) != runs[0]


def test_sampled_copies_are_poisson(spark):
    from tripaudit.operators import poisson_sample

    base = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    per = poisson_sample(base, 1.3, 1).groupBy("k").count().groupBy("count").count().toDF("copies", "rows")
    rows = {r.copies: r.rows for r in per.collect()}
    import math

    for k in range(1, 5):
        want = 40_000 * math.exp(-1.3) * 1.3**k / math.factorial(k)
        assert abs(rows[k] - want) < 5 * want**0.5
    # one row repeated many times is drawn copy by copy
    same = base.limit(1).crossJoin(spark.range(30_000)).select("k")
    assert abs(poisson_sample(same, 0.5, 1, chunk=100).count() - 15_000) < 700
    with pytest.raises(ValueError):
        poisson_sample(base, 1e6, 1)


@pytest.mark.parametrize(("year", "month", "pairs"), [
    (2024, 12, [("2023-12-01 10:00", "2024-12-01 10:00"), ("2023-12-31 23:30", "2024-12-31 23:30")]),
    (2025, 2, [("2024-02-28 01:00", "2025-02-28 01:00"), ("2024-02-29 01:00", "2025-02-28 01:00")]),
    (2024, 2, [("2023-02-28 01:00", "2024-02-28 01:00")]),
    (2025, 12, [("2024-12-31 23:50", "2025-12-31 23:50")]),
])
def test_imputed_rows_keep_their_day_of_the_month(spark, year, month, pairs):
    rows = [dict(pickup_time=a, dropoff_time=a[:-2] + "59", taxi_type="yellow") for a, _ in pairs]
    cfg = CFG.with_(impute_year=year, impute_month=month, present_threshold=1000, history_weights=(0.0, 1.0))
    got = impute_month(trips_df(spark, rows), cfg).filter("is_imputed").collect()
    assert sorted((f"{r.pickup_time:%Y-%m-%d %H:%M}", f"{r.dropoff_time - r.pickup_time}") for r in got) == sorted(
        (b, str(dt.timedelta(minutes=59 - int(a[-2:])))) for a, b in pairs)
    assert all((r.pickup_time.year, r.pickup_time.month) == (year, month) for r in got)


def test_history_scan_errors_are_raised(spark, tmp_dir):
    from tripaudit.sources import count_history_files

    assert count_history_files(spark, f"{tmp_dir}/none", 2023, 12) == 0
    assert count_history_files(spark, tmp_dir, 2023, 12) == 0
    with open(f"{tmp_dir}/green_tripdata_2023-12.parquet", "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(Exception, match="green_tripdata_2023-12"):
        count_history_files(spark, tmp_dir, 2023, 12)


def test_orders_counts(spark):
    r = impute_counts(orders_trips(spark, SF001), AuditConfig(impute_year=2001)).first()
    assert (r.n_base_old, r.n_base_new, r.n_target, r.target, r.action) == (184, 199, 0, 194, "impute")
    out = impute_month(orders_trips(spark, SF001), AuditConfig(impute_year=2001))
    assert out.filter("is_imputed").count() == 194


def test_placement_splits_a_crowded_timestamp(spark):
    from pyspark.sql import Window

    from tripaudit.operators.impute import place_groups

    # a third of the distinct rows share one pick-up instant
    rows = [dict(pickup_time="2024-12-05 10:00:00", fare=float(i), taxi_type="yellow")
            for i in range(400)]
    rows += [dict(pickup_time=f"2024-12-{1 + i % 28:02d} {i % 24:02d}:00:00", fare=float(i),
                  taxi_type="green") for i in range(800)]
    base = trips_df(spark, rows)
    cols = base.columns
    order = [F.asc_nulls_first(c) for c in cols]
    groups = base.groupBy(*cols).agg(F.count("*").alias("_m"))
    placed, total = place_groups(groups, order, 1200, rows_per_range=100)
    assert total == 1200
    # brute force: one global running sum
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    brute = groups.withColumn("_end", F.sum("_m").over(w))
    assert sorted(placed.select(*cols, "_end").collect()) == sorted(brute.select(*cols, "_end").collect())
    sizes = [r["count"] for r in placed.groupBy("_p").count().collect()]
    assert max(sizes) < 400  # the crowded instant is split across ranges


def test_fallback_history_scan(spark, tmp_dir):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    # the older history month exists only as raw files of any fleet
    t = dt.datetime(2023, 12, 3, 8, 0)
    pq.write_table(pa.table({"x": pa.array([t] * 30, pa.timestamp("us"))}),
                   os.path.join(tmp_dir, "green_tripdata_2023-12.parquet"))
    trips = _month_rows(spark, 10)  # 10 rows in Dec 2024, none in Dec 2023
    cfg = CFG.with_(present_threshold=1000)
    p = plan_imputation(trips, cfg, spark, raw_dir=tmp_dir)
    assert (p.n_base_old, p.n_base_new, p.target) == (30, 10, int(0.3 * 30 + 0.7 * 10))
    assert plan_imputation(trips, cfg, spark, raw_dir=os.path.join(tmp_dir, "none")).n_base_old == 0


def test_month_range_ignores_time_zones(spark):
    from tripaudit.functions.time import in_month

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame(
            [(dt.datetime(2000, 11, 30, 20),), (dt.datetime(2000, 12, 1),),
             (dt.datetime(2000, 12, 31, 23, 59),), (dt.datetime(2001, 1, 1),)], "t timestamp_ntz")
        got = [r.t for r in df.filter(in_month("t", 2000, 12)).collect()]
        assert got == [dt.datetime(2000, 12, 1), dt.datetime(2000, 12, 31, 23, 59)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_exact_size_uses_placed_rows(spark):
    base = _month_rows(spark, 20)
    assert exact_sample(base, 13, 999).count() == 13  # stale n still gives exactly t


def test_heavy_group_expands_in_many_tasks(spark):
    # one trip repeated 3000 times is a third of the base month
    base = _month_rows(spark, 1, dup=3000).unionByName(_month_rows(spark, 6000))
    out = exact_sample(base, 27000, 9000, chunk=100, rows_per_task=1000)
    assert out.count() == 27000
    heavy = out.filter(F.col("fare") == 0.0).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in heavy) == 3000 * 3 + 3  # its own copies plus fare 0.0 of the other rows
    assert len(heavy) > 1 and max(r["count"] for r in heavy) < 0.6 * sum(r["count"] for r in heavy)


def test_single_row_large_target(spark):
    out = exact_sample(_month_rows(spark, 1), 20000, 1, rows_per_task=1000)
    assert out.count() == 20000
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_expansion_exchange_is_not_coalescable(spark):
    out = exact_sample(_month_rows(spark, 20), 50, 20, rows_per_task=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    line = next(ln for ln in plan.splitlines() if "hashpartitioning(_j" in ln)
    assert "REPARTITION_BY_NUM" in line

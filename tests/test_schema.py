"""Unifier, explicit-schema reader and intake guards on drifting files."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF001

from tripaudit.schema import UNIFIED_COLUMNS, UNIFIED_SCHEMA, unify_schema
from tripaudit.sources.tables import TABLE_FLEETS
from tripaudit.sources import load_trips, read_fleet, source_counts

T0 = dt.datetime(2024, 1, 5, 8, 30)


def layout(schema):
    return [(f.name, f.dataType) for f in schema.fields]


def _yellow(n, id_type, extra=False, surcharge=True, month=1):
    t = T0.replace(month=month)
    cols = {
        "VendorID": pa.array([1] * n, id_type),
        "tpep_pickup_datetime": pa.array([t] * n, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([t + dt.timedelta(minutes=9)] * n, pa.timestamp("us")),
        "PULocationID": pa.array(list(range(n)), id_type),
        "DOLocationID": pa.array([4] * n, id_type),
        "trip_distance": pa.array([1.5] * n, pa.float64()),
        "fare_amount": pa.array([9.0] * n, pa.float64()),
        "tip_amount": pa.array([1.0] * n, pa.float64()),
        "total_amount": pa.array([12.5] * n, pa.float64()),
    }
    if surcharge:
        cols["congestion_surcharge"] = pa.array([2.5] * n, pa.float64())
    if extra:
        cols["airport_fee"] = pa.array([0.0] * n, pa.float64())
    return pa.table(cols)


def _green(n):
    return pa.table({
        "lpep_pickup_datetime": pa.array([T0] * n, pa.timestamp("us")),
        "lpep_dropoff_datetime": pa.array([T0] * n, pa.timestamp("us")),
        "PULocationID": pa.array([7] * n, pa.int64()),
        "DOLocationID": pa.array([12] * n, pa.int64()),
        "trip_distance": pa.array([0.0] * n, pa.float64()),
        "fare_amount": pa.array([3.0] * n, pa.float64()),
        "total_amount": pa.array([4.0] * n, pa.float64()),
    })


@pytest.fixture
def raw_dir(tmp_dir):
    pq.write_table(_yellow(3, pa.int32(), month=1), os.path.join(tmp_dir, "yellow_tripdata_2024-01.parquet"))
    pq.write_table(_yellow(4, pa.int64(), extra=True, month=2),
                   os.path.join(tmp_dir, "yellow_tripdata_2024-02.parquet"))
    pq.write_table(_yellow(2, pa.int64(), surcharge=False, month=3),
                   os.path.join(tmp_dir, "yellow_tripdata_2024-03.parquet"))
    pq.write_table(_yellow(0, pa.int64()), os.path.join(tmp_dir, "yellow_tripdata_2024-04.parquet"))
    pq.write_table(_green(5), os.path.join(tmp_dir, "green_tripdata_2024-01.parquet"))
    return tmp_dir


def test_drift_reads_with_widened_schema(spark, raw_dir):
    y = unify_schema(read_fleet(spark, raw_dir, "yellow"), "yellow")
    assert layout(y.schema) == layout(UNIFIED_SCHEMA)
    rows = y.collect()
    assert len(rows) == 9
    assert sorted(r.pickup_loc for r in rows) == [0, 0, 0, 1, 1, 1, 2, 2, 3]
    assert sum(r.congestion_surcharge is None for r in rows) == 2
    assert all(r.vendor_id == 1 and r.tip_amount == 1.0 for r in rows)


def test_load_union_and_counts(spark, raw_dir):
    trips = load_trips(spark, raw_dir)
    assert trips.columns == list(UNIFIED_COLUMNS)
    got = {r.taxi_type: r["count"] for r in source_counts(trips).collect()}
    assert got == {"yellow": 9, "green": 5}
    green = trips.filter("taxi_type = 'green'").first()
    assert green.vendor_id is None and green.tip_amount is None and green.congestion_surcharge is None


def test_fleet_without_files_is_skipped(spark, tmp_dir):
    pq.write_table(_green(2), os.path.join(tmp_dir, "green_tripdata_2024-05.parquet"))
    trips = load_trips(spark, tmp_dir)
    assert {r.taxi_type for r in trips.collect()} == {"green"}


def test_missing_directory_and_no_data(spark, tmp_dir):
    assert load_trips(spark, os.path.join(tmp_dir, "nope")) is None
    assert load_trips(spark, tmp_dir).count() == 0  # directory without any file


def test_unknown_fleet_rejected(spark, raw_dir):
    with pytest.raises(ValueError):
        load_trips(spark, raw_dir, fleets=("purple",))
    with pytest.raises(ValueError):
        unify_schema(spark.range(1), "Purple")


def test_unify_case_insensitive_and_idempotent(spark):
    df = spark.createDataFrame([(T0, 5, 3.0)], "TPEP_PICKUP_DATETIME timestamp_ntz, pulocationid long, Fare_Amount double")
    u = unify_schema(df, "YELLOW")
    assert layout(u.schema) == layout(UNIFIED_SCHEMA)
    r = u.first()
    assert (r.pickup_time, r.pickup_loc, r.fare, r.taxi_type) == (T0, 5, 3.0, "YELLOW".lower())
    again = unify_schema(u, "yellow")
    assert again.schema == u.schema and again.collect() == u.collect()


def test_csv_sink_accepts_unified_nulls(spark, tmp_dir):
    df = unify_schema(spark.range(2), "green")
    df.write.mode("overwrite").option("header", True).csv(os.path.join(tmp_dir, "nulls"))


def test_test_table_fleets(spark):
    trips = load_trips(spark, SF001, fleets=TABLE_FLEETS)
    got = {r.taxi_type: r["count"] for r in source_counts(trips).collect()}
    assert got == {"orders": 15000, "lineitem": 60000}


def test_unreadable_file_fails_unless_ignored(spark, tmp_dir):
    pq.write_table(_green(2), os.path.join(tmp_dir, "green_tripdata_2024-05.parquet"))
    with open(os.path.join(tmp_dir, "yellow_tripdata_2024-05.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    pq.write_table(_yellow(3, pa.int64()), os.path.join(tmp_dir, "yellow_tripdata_2024-06.parquet"))
    with pytest.raises(Exception, match="yellow_tripdata_2024-05"):
        load_trips(spark, tmp_dir).collect()
    # opt-in: skip only the unreadable file and keep the fleet's good files
    kept = load_trips(spark, tmp_dir, ignore_corrupt_files=True)
    got = {r.taxi_type: r["count"] for r in source_counts(kept).collect()}
    assert got == {"yellow": 3, "green": 2}


def test_failing_fleet_ends_the_run_unless_left_out(spark, tmp_dir):
    from tripaudit.plans.audit_run import read_staged, run_audit, stage_audit

    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "out")
    os.makedirs(raw)
    pq.write_table(_green(2), os.path.join(raw, "green_tripdata_2024-05.parquet"))
    pq.write_table(_yellow(3, pa.int64()), os.path.join(raw, "yellow_tripdata_2024-06.parquet"))
    with open(os.path.join(raw, "yellow_tripdata_2024-05.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(Exception, match="yellow_tripdata_2024-05"):
        stage_audit(spark, raw)
    done = stage_audit(spark, raw, skip_failed_fleets=True)
    assert list(done.skipped_fleets) == ["yellow"]
    assert {r.taxi_type: r["count"] for r in source_counts(read_staged(spark, done.path)).collect()} == {"green": 2}
    res = run_audit(spark, raw, out, skip_failed_fleets=True)
    assert not res.complete and list(res.skipped_fleets) == ["yellow"]
    assert res.frames["intake_losses"].first().fleets_left_out == "yellow"
    from tripaudit.__main__ import main

    assert main(["--raw", raw, "--out", out + "2", "--quiet", "--skip-failed-fleets"]) == 1


def test_intake_counts_ids_that_do_not_fit(spark, tmp_dir):
    from tripaudit.plans.audit_run import stage_audit

    t = pa.array([T0] * 3, pa.timestamp("us"))
    pq.write_table(pa.table({"tpep_pickup_datetime": t, "PULocationID": pa.array([5, 3_000_000_000, None], pa.int64())}),
                   os.path.join(tmp_dir, "yellow_tripdata_2024-01.parquet"))
    assert stage_audit(spark, tmp_dir).counts["ids_lost"] == 1


def test_out_of_range_id_becomes_null(spark):
    df = spark.createDataFrame([(T0, 5), (T0, 3_000_000_000)], "tpep_pickup_datetime timestamp_ntz, PULocationID long")
    got = [r.pickup_loc for r in unify_schema(df, "yellow").collect()]
    assert got == [5, None]


def test_zoned_timestamp_fleet(spark, tmp_dir):
    from pyspark.sql import types as TT

    from tripaudit.schema import YELLOW, FleetSpec

    zoned = FleetSpec("yellowz", dict(YELLOW.columns), file_glob="yellow_tripdata_*.parquet",
                      timestamp_type=TT.TimestampType())
    t = pa.array([dt.datetime(2024, 1, 5, 8, 30)], pa.timestamp("us", tz="UTC"))
    pq.write_table(pa.table({"tpep_pickup_datetime": t, "tpep_dropoff_datetime": t,
                             "PULocationID": pa.array([7], pa.int32())}),
                   os.path.join(tmp_dir, "yellow_tripdata_2024-01.parquet"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        r = unify_schema(read_fleet(spark, tmp_dir, zoned), zoned).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (r.pickup_time, r.pickup_loc, r.taxi_type) == (dt.datetime(2024, 1, 5, 8, 30), 7, "yellowz")


def test_read_explicit_file_list(spark, raw_dir):
    files = [os.path.join(raw_dir, f"yellow_tripdata_2024-0{m}.parquet") for m in (1, 2)]
    assert read_fleet(spark, files, "yellow").count() == 7

"""Ledger of landed files and upserts, batch and streamed."""

import os
import shutil

import pyarrow as pa
import pytest
from test_store import land, sorted_rows

from tripaudit.sources import compare_ledgers, read_ledger, read_taken, take_in, upsert_stream
from tripaudit.sources import ledger as ledger_module


def stream(spark, raw, out, ck, **options):
    q = upsert_stream(spark, raw, out, "yellow", checkpoint=ck, **options)
    q.awaitTermination(120)


def counts(spark, out):
    return {r.landed[-10:-8]: r["count"] for r in read_taken(spark, out).groupBy("landed").count().collect()}


@pytest.fixture
def dirs(tmp_dir):
    return [os.path.join(tmp_dir, d) for d in ("raw", "batch", "stream", "ck")]


def test_a_month_that_lands_again_replaces_its_rows_once(spark, dirs):
    raw, batch, streamed, ck = dirs
    land(f"{raw}/1", "yellow", 1, 10)
    land(f"{raw}/1", "yellow", 2, 20)
    land(f"{raw}/1", "green", 1, 5)  # another fleet's
    assert take_in(spark, raw, batch, "yellow") == 2
    stream(spark, raw, streamed, ck)
    assert counts(spark, batch) == counts(spark, streamed) == {"01": 10, "02": 20}
    land(f"{raw}/2", "yellow", 2, 23)
    land(f"{raw}/2", "yellow", 3, 7)
    before = read_ledger(spark, batch).collect()
    assert take_in(spark, raw, batch, "yellow") == 2
    stream(spark, raw, streamed, ck)
    assert counts(spark, batch) == counts(spark, streamed) == {"01": 10, "02": 23, "03": 7}
    assert sorted_rows(read_taken(spark, batch)) == sorted_rows(read_taken(spark, streamed))
    was = spark.createDataFrame(before, ledger_module.LEDGER)
    assert {r.name[-10:-8]: r.state for r in compare_ledgers(was, read_ledger(spark, batch)).collect()} == {
        "01": "same", "02": "changed", "03": "new"}
    # nothing landed since: nothing is read
    assert take_in(spark, raw, batch, "yellow") == 0
    stream(spark, raw, streamed, ck)
    assert counts(spark, streamed) == {"01": 10, "02": 23, "03": 7}


def test_a_file_changed_in_place_and_one_only_touched(spark, dirs, monkeypatch):
    raw, out, *_ = dirs
    land(raw, "yellow", 1, 10)
    path = land(raw, "yellow", 2, 20)
    take_in(spark, raw, out, "yellow")
    os.utime(path, (2_000_000_000, 2_000_000_000))
    land(raw, "yellow", 1, 10, fare_amount=pa.array([99.0] * 10))
    os.utime(os.path.join(raw, "yellow_tripdata_2024-01.parquet"), (2_000_000_001, 2_000_000_001))
    written = []
    upsert = ledger_module._upsert
    monkeypatch.setattr(ledger_module, "_upsert", lambda rows, p, key: written.append(
        (key, {r[0] for r in rows.select(key).distinct().collect()})) or upsert(rows, p, key))
    assert take_in(spark, raw, out, "yellow") == 2  # both are looked at
    assert written[0] == ("landed", {"yellow_tripdata_2024-01.parquet"})  # only the changed one is taken in
    assert {r.fare for r in read_taken(spark, out).filter("landed like '%-01.parquet'").collect()} == {99.0}
    assert counts(spark, out) == {"01": 10, "02": 20} and take_in(spark, raw, out, "yellow") == 0


def test_an_older_landing_never_comes_back(spark, dirs):
    raw, batch, streamed, ck = dirs
    for folder, n, when in (("new", 12, 2_000_000_000), ("old", 9, 1_900_000_000)):
        os.utime(land(f"{raw}/{folder}", "yellow", 1, n), (when, when))
    take_in(spark, raw, batch, "yellow")
    stream(spark, raw, streamed, ck, max_files_per_trigger=1)
    assert counts(spark, batch) == counts(spark, streamed) == {"01": 12}
    os.utime(land(f"{raw}/older", "yellow", 1, 4), (1_800_000_000, 1_800_000_000))
    assert take_in(spark, raw, batch, "yellow") == 0
    stream(spark, raw, streamed, ck)
    assert counts(spark, batch) == counts(spark, streamed) == {"01": 12}


def test_a_run_that_stops_between_trips_and_ledger_is_repeated(spark, dirs, monkeypatch):
    raw, out, *_ = dirs
    land(raw, "yellow", 1, 10)
    upsert = ledger_module._upsert

    def stops(rows, path, key):
        if key == "name":
            raise RuntimeError("lost")
        upsert(rows, path, key)

    monkeypatch.setattr(ledger_module, "_upsert", stops)
    with pytest.raises(RuntimeError):
        take_in(spark, raw, out, "yellow")
    monkeypatch.undo()
    assert take_in(spark, raw, out, "yellow") == 1 and counts(spark, out) == {"01": 10}


def test_digest_does_not_depend_on_layout(spark, dirs):
    raw, out, *_ = dirs
    path = land(raw, "yellow", 1, 50)
    take_in(spark, raw, out, "yellow")
    first = read_ledger(spark, out).first()
    table = spark.read.parquet(path).repartition(1).sortWithinPartitions("fare_amount", ascending=False)
    table.write.option("compression", "gzip").parquet(f"{raw}-again")
    part = next(f for f in os.listdir(f"{raw}-again") if f.endswith(".parquet"))
    os.makedirs(f"{raw}/again")
    shutil.copy(f"{raw}-again/{part}", f"{raw}/again/yellow_tripdata_2024-01.parquet")
    assert take_in(spark, raw, out, "yellow") == 1
    second = read_ledger(spark, out).first()
    assert (first.rows, first.content) == (second.rows, second.content) and first.path != second.path


def test_taking_in_sorts_and_shuffles_no_rows(spark, dirs, monkeypatch):
    """A landed file is written where it is read: no task gathers or sorts a whole file."""
    raw, batch, streamed, ck = dirs
    for month in (1, 2, 3):
        land(raw, "yellow", month, 400)
    asked = []
    upsert = ledger_module._upsert

    def noting(rows, path, key):
        if key == "landed":
            asked.append(rows._jdf.queryExecution().optimizedPlan().toString())
        upsert(rows, path, key)

    monkeypatch.setattr(ledger_module, "_upsert", noting)
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    own, held = spark.conf.get(conf), []
    opened = ledger_module.open_files
    monkeypatch.setattr(ledger_module, "open_files", lambda s: held.append(opened(s)) or held[-1])
    take_in(spark, raw, batch, "yellow")
    stream(spark, raw, streamed, ck)
    assert counts(spark, batch) == counts(spark, streamed) == {"01": 400, "02": 400, "03": 400}
    assert len(asked) == 2 and "rightHint=(strategy=broadcast)" in asked[1]
    assert len(held) == 4 and spark.conf.get(conf) == own

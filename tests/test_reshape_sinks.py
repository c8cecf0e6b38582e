"""Pivot and series reshapes; Parquet/CSV round trips."""

import datetime as dt
import os

import pytest
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tripaudit.operators import tip_series, velocity_pivot
from tripaudit.sources import read_csv, read_reports, write_csv, write_parquet


def test_pivot(spark):
    heat = spark.createDataFrame([(8, 2, 10.5), (9, 3, 12.0), (10, 4, 11.2)],
                                 "hour int, day_of_week int, avg_speed double")
    p = {r.day_of_week: r for r in velocity_pivot(heat).collect()}
    assert len(p) == 3 and len(p[2]) == 25
    assert p[2]["8"] == 10.5 and p[3]["9"] == 12.0 and p[4]["10"] == 11.2
    assert p[2]["9"] is None and p[3]["8"] is None


def test_tip_series(spark):
    df = spark.createDataFrame([(2024, 1, 2.5, 3.0), (2024, 2, 2.7, 3.2)],
                               "year int, month int, avg_surcharge double, avg_tip_amount double")
    assert [r.date for r in tip_series(df).orderBy("date").collect()] == [
        dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_round_trips(spark, tmp_dir):
    df = spark.createDataFrame([(2024, 1, "yellow", 5), (2024, 2, None, 7)],
                               "year int, month int, taxi_type string, count long")
    schema = T.StructType.fromJson(df.schema.jsonValue())
    csv = write_csv(df, os.path.join(tmp_dir, "q1"))
    assert sorted(read_csv(spark, csv, schema).collect()) == sorted(df.collect())
    pq = write_parquet(df, os.path.join(tmp_dir, "pq"))
    assert sorted(spark.read.parquet(pq).collect()) == sorted(df.collect())
    paths, schemas = {"q1": csv, "gone": os.path.join(tmp_dir, "missing")}, {"q1": schema, "gone": schema}
    with pytest.raises(AnalysisException, match="missing"):
        read_reports(spark, paths, schemas)
    got = read_reports(spark, paths, schemas, skip_failed=True)
    assert list(got.frames) == ["q1"] and list(got.failed) == ["gone"]

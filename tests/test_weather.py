"""Weather reshape, join, NULL-safe correlation and trend."""

import datetime as dt

import pytest

from tripaudit.operators import rain_elasticity, rain_join, rain_trend
from tripaudit.sources import weather_rows


def _docs(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "json string")


def test_reshape(spark):
    doc = '{"daily":{"time":["2025-01-01","2025-01-02"],"precipitation_sum":[0.1,null]}}'
    rows = weather_rows(_docs(spark, doc)).orderBy("date").collect()
    assert [(r.date, r.precipitation) for r in rows] == [
        (dt.date(2025, 1, 1), 0.1), (dt.date(2025, 1, 2), None)]
    assert weather_rows(_docs(spark, "{}")).count() == 0
    bad = '{"daily":{"time":["2025-13-45","2025-01-02"],"precipitation_sum":[1.0,2.0]}}'
    assert [r.date for r in weather_rows(_docs(spark, bad)).collect()] == [None, dt.date(2025, 1, 2)]


def _pairs(spark, pairs):
    return spark.createDataFrame(pairs, "total_trips long, precipitation double")


def test_correlation_null_safe(spark):
    r = rain_elasticity(_pairs(spark, [(1, 2.0), (2, 3.0), (5, None), (4, 9.0)])).first()
    assert r.n == 3 and r.correlation == pytest.approx(0.97986371, abs=1e-8)
    assert rain_elasticity(_pairs(spark, [(1, 2.0)])).first().correlation is None
    assert rain_elasticity(_pairs(spark, [(1, 2.0), (3, 2.0), (4, 2.0)])).first().correlation is None


def test_trend(spark):
    r = rain_trend(_pairs(spark, [(1, 0.0), (3, 1.0), (5, 2.0)])).first()
    assert (r.slope, r.intercept, r.r2, r.n) == (2.0, 1.0, 1.0, 3)


def test_join_drops_one_sided_days(spark):
    daily = spark.createDataFrame([(dt.date(2025, 1, 1), 10), (dt.date(2025, 1, 3), 5)],
                                  "date date, total_trips long")
    doc = '{"daily":{"time":["2025-01-01","2025-01-02"],"precipitation_sum":[0.5,1.0]}}'
    got = [tuple(r) for r in rain_join(daily, weather_rows(_docs(spark, doc))).collect()]
    assert got == [(dt.date(2025, 1, 1), 10, 0.5)]


def test_empty_inputs_give_null_statistics(spark):
    empty = _pairs(spark, [])
    r = rain_elasticity(empty).first()
    assert r.n == 0 and r.correlation is None
    t = rain_trend(empty).first()
    assert t.n == 0 and t.slope is None


def test_duplicate_days_multiply_like_an_inner_merge(spark):
    daily = spark.createDataFrame([(dt.date(2025, 1, 1), 10)], "date date, total_trips long")
    docs = _docs(spark,
                 '{"daily":{"time":["2025-01-01"],"precipitation_sum":[0.5]}}',
                 '{"daily":{"time":["2025-01-01"],"precipitation_sum":[0.7]}}')
    got = sorted(tuple(r) for r in rain_join(daily, weather_rows(docs)).collect())
    assert got == [(dt.date(2025, 1, 1), 10, 0.5), (dt.date(2025, 1, 1), 10, 0.7)]


def test_year_bounds_and_unread_days(spark):
    import datetime as dt

    from tripaudit.sources import in_year, unread_days, weather_rows

    doc = '{"daily":{"time":["2024-12-31","2025-01-01","2025-12-31","2026-01-01","soon"],"precipitation_sum":[1,2,3,4,5]}}'
    days = weather_rows(spark.createDataFrame([(doc,)], "json string"))
    assert [r.date for r in in_year(days, 2025).collect()] == [dt.date(2025, 1, 1), dt.date(2025, 12, 31)]
    assert in_year(days, None).count() == 5
    assert unread_days(days).first()[0] == 1

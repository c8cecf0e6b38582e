"""Physical plan shape: pushdown, pruning, top-k, no Python in the plan."""

import re

import pytest
from conftest import SF0001

import __spark_entry__ as E
from tripaudit.config import AuditConfig
from tripaudit.operators import audit_leakage, impute_counts, mark_zone, split_ghosts
from tripaudit.sources.tables import events_trips, orders_trips


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_month_range_pushed_to_scan(spark):
    p = formatted(impute_counts(orders_trips(spark, SF0001), AuditConfig(impute_year=2001)))
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_leakage_is_topk(spark):
    df = audit_leakage(mark_zone(split_ghosts(events_trips(spark, SF0001)).clean))
    p = formatted(df)
    assert "TakeOrderedAndProject" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


# The reports of one run share their plans: two of them stand for all.
NAMES = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$|run_(?!heatmap|rain_days)", n))
BANNED = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
          "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", NAMES)
def test_no_python_udf(spark, name):
    p = formatted(E.queries()[name](spark, SF0001))
    for node in BANNED:
        assert node not in p, f"{name}: {node}"


def test_written_plans_have_no_python_and_no_single_partition(spark, monkeypatch):
    """The plans of the queries that write: checked where the write happens."""
    from tripaudit.plans import suite

    seen = []

    def capture(df, path, *args, **kwargs):
        seen.append(formatted(df))
        df.write.mode("overwrite").parquet(path) if "audit" in path else df.write.option("header", True).csv(path)
        return path

    monkeypatch.setattr(suite, "write_parquet", capture)
    monkeypatch.setattr(suite, "write_csv", capture)
    for name in ("parquet_roundtrip", "csv_roundtrip"):
        E.queries()[name](spark, SF0001).collect()
    assert len(seen) == 2
    for p in seen:
        assert not any(node in p for node in BANNED) and "SinglePartition" not in p
    assert "HashAggregate" in seen[1]


def test_imputation_moves_rows_once_by_range_and_once_by_id(spark):
    from pyspark.sql import functions as F

    from tripaudit.operators.impute import place_groups

    base = orders_trips(spark, SF0001)
    groups = base.groupBy(*base.columns).agg(F.count("*").alias("_m"))
    seen = []
    real = type(groups).checkpoint

    def capture(df, *args, **kwargs):
        seen.append(plan(df))
        return real(df, *args, **kwargs)

    type(groups).checkpoint, keep = capture, real
    try:
        place_groups(groups, [F.asc_nulls_first(c) for c in base.columns], 1500, rows_per_range=300)
    finally:
        type(groups).checkpoint = keep
    assert "hashpartitioning(_p" in seen[0] and ", 5), REPARTITION_BY_NUM" in seen[0]

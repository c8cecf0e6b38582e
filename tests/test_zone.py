"""Zone marking, compliance, leakage and zone aggregates."""

import pytest
from conftest import SF0001
from helpers import trips_df

from tripaudit.operators import (
    audit_leakage,
    border_effect,
    mark_zone,
    mark_zone_table,
    split_ghosts,
    surcharge_compliance,
    velocity_heatmap,
)
from tripaudit.sources.tables import events_trips


def test_mark_zone_three_valued(spark):
    df = trips_df(spark, [dict(dropoff_loc=4), dict(dropoff_loc=5), dict(dropoff_loc=None)])
    assert [r.inside_zone for r in mark_zone(df).collect()] == [True, False, None]


def test_compliance_counts_null_surcharge_in_total_only(spark):
    rows = [dict(dropoff_loc=4, congestion_surcharge=s, taxi_type="yellow") for s in (2.5, 0.0, None)]
    rows.append(dict(dropoff_loc=5, congestion_surcharge=2.5, taxi_type="yellow"))
    r = surcharge_compliance(mark_zone(trips_df(spark, rows))).first()
    assert (r.taxi_type, r.total_zone_trips, r.paid_surcharge) == ("yellow", 3, 1)


def test_leakage_top3_with_tie_break(spark):
    rows = [dict(dropoff_loc=4, congestion_surcharge=0.0, pickup_loc=p) for p in (9, 9, 8, 8, 7, 7, 6)]
    rows += [dict(dropoff_loc=4, congestion_surcharge=None, pickup_loc=1)] * 5
    got = [tuple(r) for r in audit_leakage(mark_zone(trips_df(spark, rows))).collect()]
    assert got == [(7, 2), (8, 2), (9, 2)]


def test_heatmap_requires_zone_flag(spark):
    with pytest.raises(ValueError):
        velocity_heatmap(trips_df(spark, [dict(dropoff_loc=4)]))


def test_sf0001_zone_numbers(spark):
    clean = split_ghosts(events_trips(spark, SF0001)).clean
    marked = mark_zone(clean)
    comp = {r.taxi_type: (r.total_zone_trips, r.paid_surcharge)
            for r in surcharge_compliance(marked).collect()}
    assert comp == {"green": (96, 55), "yellow": (60, 35)}
    assert velocity_heatmap(marked).count() == 101
    assert border_effect(clean).count() == 263


def test_zone_table_matches_list(spark):
    from tripaudit.config import ZONE_IDS

    clean = split_ghosts(events_trips(spark, SF0001)).clean
    zones = spark.createDataFrame([(z, "Manhattan") for z in ZONE_IDS] + [(ZONE_IDS[0], "dup")],
                                  "LocationID long, borough string")
    a = sorted((r.event_id, r.inside_zone) for r in mark_zone(clean).select("event_id", "inside_zone").collect())
    b = sorted((r.event_id, r.inside_zone) for r in
               mark_zone_table(clean, zones).select("event_id", "inside_zone").collect())
    assert a == b and any(v is None for _, v in a)

"""Independent SQL (DuckDB dialect) for every registered query that SQL can
express.  Views ``orders lineitem events pages ...`` are provided by the
caller.  Numbers that must agree with the Spark side come from the same
config objects (zone list, thresholds, imputation months, link tokens).
"""

from __future__ import annotations

from tripaudit.config import DEFAULT, ZONE_IDS
from tripaudit.functions.time import month_bounds
from tripaudit.plans import suite
from tripaudit.schema import UNIFIED_COLUMNS

DIG = suite.DIGITS
ZONES = ", ".join(str(z) for z in ZONE_IDS)
CFG = DEFAULT
OCFG = suite.ORDERS_CFG


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STRIP = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"

TRIPS_EV = f"""
trips_ev AS (
  SELECT
    ts AS pickup_time,
    ts + to_seconds((event_id * 7919) % 3600 - 30) AS dropoff_time,
    CAST(user_id % 50 AS INTEGER) AS pickup_loc,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 265 AS INTEGER) END AS dropoff_loc,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST((event_id % 97) / 4 AS DOUBLE) END AS trip_distance,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS fare,
    value * CAST(1.25 AS DOUBLE) AS total_amount,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST((event_id % 3) * 1.25 AS DOUBLE) END AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS tip_amount,
    CAST(user_id % 6 AS INTEGER) AS vendor_id,
    CASE WHEN event_type IN ('view', 'click') THEN 'yellow' ELSE 'green' END AS taxi_type,
    event_id
  FROM events
),
m1 AS (SELECT *, date_diff('second', pickup_time, dropoff_time) AS duration_seconds FROM trips_ev),
m2 AS (SELECT *, duration_seconds / CAST(3600.0 AS DOUBLE) AS duration_hours FROM m1),
m3 AS (
  SELECT *, CASE WHEN duration_hours > CAST({CFG.min_hours_for_speed} AS DOUBLE)
                 THEN trip_distance / duration_hours ELSE CAST(0 AS DOUBLE) END AS speed_mph
  FROM m2
),
flagged AS (
  SELECT *,
    (speed_mph > {CFG.speed_limit_mph}
     OR (duration_seconds < {CFG.min_trip_seconds} AND fare > {CFG.short_trip_fare})
     OR (trip_distance = 0 AND fare > 0)) AS is_ghost
  FROM m3
),
clean AS (SELECT * EXCLUDE (is_ghost) FROM flagged WHERE NOT is_ghost)"""

TRIPS_ORD = """
trips_ord AS (
  SELECT
    o_orderdate AS pickup_time,
    CAST(NULL AS TIMESTAMP) AS dropoff_time,
    TRY_CAST(o_custkey AS INTEGER) AS pickup_loc,
    CAST(NULL AS INTEGER) AS dropoff_loc,
    CAST(NULL AS DOUBLE) AS trip_distance,
    o_totalprice AS fare,
    CAST(NULL AS DOUBLE) AS total_amount,
    CAST(NULL AS DOUBLE) AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS tip_amount,
    CAST(NULL AS INTEGER) AS vendor_id,
    o_orderstatus AS taxi_type
  FROM orders
)"""

TRIPS_LI = """
trips_li AS (
  SELECT
    l_shipdate AS pickup_time,
    l_extendedprice AS fare,
    l_extendedprice * (CAST(1.0 AS DOUBLE) + l_tax) AS total_amount,
    l_tax AS congestion_surcharge
  FROM lineitem
)"""

FLEET_ORDERS = """
  SELECT o_orderdate AS pickup_time, CAST(NULL AS TIMESTAMP) AS dropoff_time,
    TRY_CAST(o_custkey AS INTEGER) AS pickup_loc, CAST(NULL AS INTEGER) AS dropoff_loc,
    CAST(NULL AS DOUBLE) AS trip_distance, o_totalprice AS fare,
    CAST(NULL AS DOUBLE) AS total_amount, CAST(NULL AS DOUBLE) AS congestion_surcharge,
    CAST(NULL AS DOUBLE) AS tip_amount, CAST(NULL AS INTEGER) AS vendor_id,
    'orders' AS taxi_type
  FROM orders"""

FLEET_LINEITEM = """
  SELECT l_shipdate AS pickup_time, CAST(NULL AS TIMESTAMP) AS dropoff_time,
    TRY_CAST(l_suppkey AS INTEGER) AS pickup_loc, TRY_CAST(l_partkey AS INTEGER) AS dropoff_loc,
    l_quantity AS trip_distance, l_extendedprice AS fare,
    CAST(NULL AS DOUBLE) AS total_amount, l_tax AS congestion_surcharge,
    l_discount AS tip_amount, TRY_CAST(l_linenumber AS INTEGER) AS vendor_id,
    'lineitem' AS taxi_type
  FROM lineitem"""

RIDES = """
  SELECT pickup_time, pickup_time + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 3600 - 30) AS dropoff_time,
    CAST(l_suppkey % 50 AS INTEGER) AS pickup_loc,
    CASE WHEN l_orderkey % 17 <> 0 THEN CAST(l_partkey % 265 AS INTEGER) END AS dropoff_loc,
    CASE WHEN l_orderkey % 13 <> 0 THEN CAST((l_orderkey % 97) / 4 AS DOUBLE) END AS trip_distance,
    CASE WHEN l_orderkey % 11 <> 0 THEN l_extendedprice / CAST(997 AS DOUBLE) END AS fare,
    l_extendedprice / CAST(997 AS DOUBLE) * CAST(1.25 AS DOUBLE) + l_tax AS total_amount,
    CASE WHEN l_orderkey % 7 <> 0 THEN (l_linenumber % 3) * CAST(1.25 AS DOUBLE) END AS congestion_surcharge,
    l_discount AS tip_amount, CAST(l_linenumber AS INTEGER) AS vendor_id,
    CASE WHEN l_returnflag = 'N' THEN 'rides_n' ELSE 'rides_r' END AS taxi_type
  FROM (SELECT *, l_shipdate + to_seconds((l_orderkey * 613 + l_linenumber * 7) % 86400) AS pickup_time FROM lineitem)"""

# Links by this file's own reading of the test pages: quoted attributes, five entities.
HARVEST = rf"""
visible AS (
  SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<(script|style)[\s>].*?</(script|style)>', '', 'g') AS body
  FROM pages
),
raw_links AS (
  SELECT page_id, unnest(l) AS raw, unnest(range(len(l))) AS pos
  FROM (SELECT page_id, regexp_extract_all(body, '(?i)<a\s+(?:[a-z-]+="[^"]*"\s+)*href="([^"]*)"', 1) AS l FROM visible)
),
decoded_links AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos,
    trim(replace(replace(replace(replace(replace(raw, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
      '&#39;', chr(39)), '&amp;', '&'), {STRIP}) AS href
  FROM raw_links
),
harvest AS (
  SELECT page_id, pos, href, string_split(href, '/')[-1] AS filename FROM decoded_links
)"""

WEATHER = """
weather AS (
  SELECT CAST(l_shipdate AS DATE) AS date, avg(l_tax) AS precipitation
  FROM lineitem GROUP BY 1
),
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS total_trips FROM orders GROUP BY 1
),
j AS (
  SELECT d.date, d.total_trips, w.precipitation FROM daily d JOIN weather w ON d.date = w.date
)"""


def _month(col: str, year: int, month: int) -> str:
    a, b = month_bounds(year, month)
    return f"({col} >= TIMESTAMP '{a:%Y-%m-%d %H:%M:%S}' AND {col} < TIMESTAMP '{b:%Y-%m-%d %H:%M:%S}')"


def _impute_counts_cte(src: str = "trips_ord", cfg=OCFG) -> str:
    y, m = cfg.impute_year, cfg.impute_month
    w_old, w_new = cfg.history_weights
    return f"""
counts AS (
  SELECT
    count(*) FILTER (WHERE {_month('pickup_time', y - 2, m)}) AS n_base_old,
    count(*) FILTER (WHERE {_month('pickup_time', y - 1, m)}) AS n_base_new,
    count(*) FILTER (WHERE {_month('pickup_time', y, m)}) AS n_target
  FROM {src}
),
plan AS (
  SELECT *, CAST(floor(CAST({w_old} AS DOUBLE) * n_base_old + CAST({w_new} AS DOUBLE) * n_base_new) AS BIGINT) AS target
  FROM counts
),
decision AS (
  SELECT *,
    CASE WHEN n_base_new > 0 THEN target / n_base_new END AS fraction,
    CASE WHEN n_target > {cfg.present_threshold} THEN 'present'
         WHEN target = 0 THEN 'no_history'
         WHEN n_base_new = 0 THEN 'empty_base'
         ELSE 'impute' END AS action
  FROM plan
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


EV_OUT = ", ".join(list(UNIFIED_COLUMNS) + ["event_id", "duration_seconds", "duration_hours",
                                            "speed_mph"])
UNI = ", ".join(UNIFIED_COLUMNS)


def _heatmap() -> str:
    return f"""
heat AS (
  SELECT CAST(hour(pickup_time) AS INTEGER) AS hour,
         CAST(dayofweek(pickup_time) + 1 AS INTEGER) AS day_of_week,
         round(avg(speed_mph), {DIG}) AS avg_speed
  FROM clean WHERE dropoff_loc IN ({ZONES})
  GROUP BY 1, 2
)"""


def _tips() -> str:
    return f"""
tips AS (
  SELECT CAST(year(pickup_time) AS INTEGER) AS year, CAST(month(pickup_time) AS INTEGER) AS month,
         round(avg(congestion_surcharge), {DIG}) AS avg_surcharge,
         round(avg(total_amount - fare), {DIG}) AS avg_tip_amount
  FROM trips_li GROUP BY 1, 2
)"""


def _link_map(name: str, years, fleets, extra: str = "") -> str:
    def any_of(toks):
        return "(" + " OR ".join(f"contains(filename, {_q(t)})" for t in toks) + ")"

    return f"""
{name} AS (
  SELECT filename, href AS url FROM (
    SELECT *, row_number() OVER (PARTITION BY filename ORDER BY page_id DESC, pos DESC) AS rn
    FROM harvest
    WHERE ends_with(href, {_q(suite.LINK_SUFFIX)}) AND {any_of(years)} AND {any_of(fleets)}
  ) WHERE rn = 1 {extra}
)"""


def _imputed_ctes(src: str, cfg=OCFG, sampled: bool = False) -> str:
    """CTEs ``decision``, ``expanded`` and ``all_trips`` (src + imputed rows)."""
    y, m = cfg.impute_year, cfg.impute_month
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in UNIFIED_COLUMNS)
    days = "to_days(CAST(date_diff('day', CAST(pickup_time AS DATE), CAST(pickup_time AS DATE) + INTERVAL 1 YEAR) AS INTEGER))"
    shifted = ", ".join(f"{c} + {days} AS {c}" if c in ("pickup_time", "dropoff_time") else c
                        for c in UNIFIED_COLUMNS)
    money = ("trip_distance", "fare", "total_amount", "congestion_surcharge", "tip_amount")
    key = " || '|' || ".join(
        f"coalesce(CAST({f'CAST(round({c} * 100) AS BIGINT)' if c in money else c} AS VARCHAR), '~')"
        for c in UNIFIED_COLUMNS)
    base = f"""
base AS (
  SELECT {UNI}, row_number() OVER (ORDER BY {order}) - 1 AS i, row_number() OVER (PARTITION BY {UNI}) - 1 AS twin
  FROM {src} WHERE {_month('pickup_time', y - 1, m)}
)"""
    exact = """
rep AS (
  SELECT base.*, CAST((CAST(i + 1 AS HUGEINT) * target) // n_base_new
                      - (CAST(i AS HUGEINT) * target) // n_base_new AS BIGINT) AS copies
  FROM base, decision WHERE decision.action = 'impute'
)"""
    drawn = f"""
steps AS (
  SELECT k, sum(p) OVER (ORDER BY k) AS cum
  FROM (SELECT k, exp(-fraction + k * ln(fraction) - lgamma(k + 1)) AS p
        FROM decision, (SELECT unnest(range(60)) AS k) WHERE action = 'impute')
),
rep AS (
  SELECT *, (SELECT count(*) FROM steps WHERE u >= cum) AS copies
  FROM (SELECT *, CAST(('0x' || substr(md5('{cfg.impute_seed}|' || {key} || '|' || twin), 1, 13)) AS BIGINT)
               / CAST(4503599627370496 AS DOUBLE) AS u FROM base)
)"""
    return _impute_counts_cte(src, cfg) + "," + base + "," + (drawn if sampled else exact) + f""",
expanded AS (SELECT {UNI}, unnest(range(copies)) AS k FROM rep),
all_trips AS (
  SELECT {UNI}, false AS is_imputed FROM {src}
  UNION ALL
  SELECT {shifted}, true AS is_imputed FROM expanded
)"""


def _impute_month_sql(cfg=OCFG, sampled: bool = False) -> str:
    return _with(TRIPS_ORD, _imputed_ctes("trips_ord", cfg, sampled)) + "SELECT * FROM all_trips"


def _audit_sql(select: str, fleets: str = f"{FLEET_ORDERS}\n  UNION ALL\n{FLEET_LINEITEM}") -> str:
    """A query over ``af``, the flagged trips of the fleets with the imputed month."""
    return _with(f"fleets AS ({fleets})",
                 _imputed_ctes("fleets"), f"""
a1 AS (SELECT *, date_diff('second', pickup_time, dropoff_time) AS duration_seconds FROM all_trips),
a2 AS (SELECT *, duration_seconds / CAST(3600.0 AS DOUBLE) AS duration_hours FROM a1),
a3 AS (
  SELECT *, CASE WHEN duration_hours > CAST({CFG.min_hours_for_speed} AS DOUBLE)
                 THEN trip_distance / duration_hours ELSE CAST(0 AS DOUBLE) END AS speed_mph
  FROM a2
),
af AS (
  SELECT *,
    (speed_mph > {CFG.speed_limit_mph}
     OR (duration_seconds < {CFG.min_trip_seconds} AND fare > {CFG.short_trip_fare})
     OR (trip_distance = 0 AND fare > 0)) AS is_ghost,
    dropoff_loc IN ({ZONES}) AS inside_zone
  FROM a3
)""") + select


AUDIT_ACCOUNTING = """SELECT taxi_type, is_imputed, count(*) AS total,
  count(*) FILTER (WHERE NOT is_ghost) AS clean,
  count(*) FILTER (WHERE is_ghost) AS audit,
  count(*) FILTER (WHERE is_ghost IS NULL) AS undetermined,
  count(*) FILTER (WHERE NOT is_ghost AND inside_zone) AS clean_in_zone
FROM af GROUP BY 1, 2"""


def _run_sql() -> dict[str, str]:
    """Reports of the run over the rides, each straight from the flagged trips."""
    def rides(select: str) -> str:
        return _audit_sql(select, RIDES)

    year, month = "CAST(year(pickup_time) AS INTEGER) AS year", "CAST(month(pickup_time) AS INTEGER) AS month"
    rain = """, wet AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_tax) AS precipitation FROM lineitem GROUP BY 1),
days AS (SELECT CAST(pickup_time AS DATE) AS date, count(*) AS total_trips FROM af WHERE NOT is_ghost GROUP BY 1),
j AS (SELECT date, total_trips, precipitation FROM days JOIN wet USING (date))"""

    def rainy(select: str) -> str:
        # One more CTE in front of the final SELECT.
        head, mark, tail = rides("--\nSELECT 1").rpartition("--\nSELECT 1")
        return head.rstrip() + rain + "\n" + select + tail

    return {
        "run_source_counts": rides("SELECT taxi_type, count(*) AS count FROM af WHERE NOT is_imputed GROUP BY 1"),
        "run_period_summary": rides(f"""SELECT {year}, {month}, count(*) AS count FROM af WHERE NOT is_imputed
            GROUP BY 1, 2 ORDER BY 1, 2"""),
        "run_volume": rides(f"""SELECT {year}, CAST(quarter(pickup_time) AS INTEGER) AS quarter, taxi_type,
            count(*) AS count FROM af WHERE NOT is_ghost GROUP BY 1, 2, 3"""),
        "run_tips": rides(f"""SELECT {year}, {month}, round(avg(congestion_surcharge), {DIG}) AS avg_surcharge,
            round(avg(total_amount - fare), {DIG}) AS avg_tip_amount FROM af WHERE NOT is_ghost GROUP BY 1, 2"""),
        "run_border": rides(f"SELECT dropoff_loc, {year}, count(*) AS count FROM af WHERE NOT is_ghost GROUP BY 1, 2"),
        "run_heatmap": rides(f"""SELECT CAST(hour(pickup_time) AS INTEGER) AS hour,
            CAST(dayofweek(pickup_time) + 1 AS INTEGER) AS day_of_week, round(avg(speed_mph), {DIG}) AS avg_speed
            FROM af WHERE NOT is_ghost AND inside_zone GROUP BY 1, 2"""),
        "run_rain_days": rainy(f"SELECT date, total_trips, round(precipitation, {DIG}) AS precipitation FROM j"),
        "run_rain_correlation": rainy(f"""SELECT count(*) AS n,
            round(corr(CAST(total_trips AS DOUBLE), precipitation), {DIG}) AS correlation FROM j"""),
        "run_rain_trend": rainy(f"""SELECT round(regr_slope(y, x), {DIG}) AS slope,
            round(regr_intercept(y, x), {DIG}) AS intercept, round(regr_r2(y, x), {DIG}) AS r2,
            CAST(regr_count(y, x) AS BIGINT) AS n
            FROM (SELECT CAST(total_trips AS DOUBLE) AS y, precipitation AS x FROM j)"""),
        "run_incremental": rides(AUDIT_ACCOUNTING.replace(
            "FROM af GROUP BY 1, 2", f", CAST({len(suite.RIDE_FLEETS)} AS INTEGER) AS batches_reused FROM af GROUP BY 1, 2")),
        "run_compacted": rides(f"""SELECT {UNI}, is_imputed, CAST({len(suite.RIDE_FLEETS)} AS INTEGER) AS batches_reused
            FROM af WHERE is_ghost"""),
    }


def _file_sql() -> dict[str, str]:
    """Trips of files whose types drifted, and of good files beside bad ones."""
    def held(c: str) -> str:
        return (f"CASE WHEN l_orderkey % 4 = 2 AND l_orderkey % 10 = 0 THEN NULL "
                f"WHEN l_orderkey % 4 = 3 AND l_linenumber = 7 THEN NULL ELSE CAST({c} AS INTEGER) END")

    ids = ("l_suppkey", "l_partkey", "l_linenumber")
    drift = FLEET_LINEITEM
    for c in ids:
        drift = drift.replace(f"TRY_CAST({c} AS INTEGER)", held(c))
    return {
        "drift_trips": drift,
        "drift_losses": f"""SELECT count(*) AS trips,
            CAST({len(ids)} * count(*) FILTER (WHERE {held("l_suppkey")} IS NULL) AS BIGINT) AS ids_lost,
            CAST(3 AS INTEGER) AS read_schemas FROM lineitem""",
        "intake_upsert": f"""SELECT landed, n AS batch_trips, fares AS batch_fares, n AS stream_trips, fares AS stream_fares
            FROM (SELECT 'rides_tripdata_' || year(pickup_time) || '.parquet' AS landed, count(*) AS n,
                    round(sum(CASE WHEN year(pickup_time) = {suite.CHANGED_YEAR} THEN fare * 2 ELSE fare END), 3) AS fares
                  FROM ({RIDES}) GROUP BY 1)""",
        "quarantine_kept": FLEET_ORDERS + f"\n  WHERE o_orderkey % {suite.PIECES} < {suite.PIECES - 1}",
        "quarantine_files": f"""SELECT CAST(o_orderkey % {suite.PIECES} AS INTEGER) AS piece, count(*) AS trips,
            o_orderkey % {suite.PIECES} = {suite.PIECES - 1} AS left_out FROM orders GROUP BY 1, 3
            UNION ALL SELECT {suite.PIECES}, NULL, true""",
    }


def oracle_sql() -> dict[str, str]:
    zone = f"dropoff_loc IN ({ZONES})"
    ev = _with(TRIPS_EV)
    od = _with(TRIPS_ORD)
    out = {
        "source_counts": f"SELECT taxi_type, count(*) AS count FROM ({FLEET_ORDERS} UNION ALL {FLEET_LINEITEM}) GROUP BY taxi_type",
        "unify_schema": FLEET_LINEITEM,
        "union_fleets": f"{FLEET_ORDERS}\nUNION ALL\n{FLEET_LINEITEM}",
        "period_summary": od + """SELECT CAST(year(pickup_time) AS INTEGER) AS year,
            CAST(month(pickup_time) AS INTEGER) AS month, count(*) AS count
            FROM trips_ord GROUP BY 1, 2 ORDER BY 1, 2""",
        "impute_counts": _with(TRIPS_ORD, _impute_counts_cte()) + f"""SELECT n_base_old, n_base_new,
            n_target, target, round(fraction, {DIG}) AS fraction, action FROM decision""",
        "impute_month": _impute_month_sql(),
        "trip_metrics": ev + """SELECT event_id, pickup_time, dropoff_time, trip_distance,
            duration_seconds, duration_hours, speed_mph FROM m3""",
        "ghost_clean": ev + f"SELECT {EV_OUT} FROM flagged WHERE NOT is_ghost",
        "ghost_audit": ev + f"SELECT {EV_OUT} FROM flagged WHERE is_ghost",
        "ghost_undetermined": ev + f"SELECT {EV_OUT} FROM flagged WHERE is_ghost IS NULL",
        "row_accounting": ev + f"""SELECT count(*) AS total,
            count(*) FILTER (WHERE NOT is_ghost) AS clean,
            count(*) FILTER (WHERE is_ghost) AS audit,
            count(*) FILTER (WHERE is_ghost IS NULL) AS undetermined,
            count(*) FILTER (WHERE speed_mph > {CFG.speed_limit_mph}) AS rule_a,
            count(*) FILTER (WHERE duration_seconds < {CFG.min_trip_seconds} AND fare > {CFG.short_trip_fare}) AS rule_b,
            count(*) FILTER (WHERE trip_distance = 0 AND fare > 0) AS rule_c
            FROM flagged""",
        "ghost_vendors": ev + f"""SELECT vendor_id, count(*) AS count FROM flagged WHERE is_ghost
            GROUP BY vendor_id ORDER BY count DESC, vendor_id ASC NULLS FIRST LIMIT {CFG.top_vendors}""",
        "mark_zone": ev + f"SELECT event_id, dropoff_loc, {zone} AS inside_zone FROM clean",
        "surcharge_compliance": ev + f"""SELECT taxi_type, count(*) AS total_zone_trips,
            count(CASE WHEN congestion_surcharge > 0 THEN 1 END) AS paid_surcharge
            FROM clean WHERE {zone} GROUP BY taxi_type""",
        "audit_leakage": ev + f"""SELECT pickup_loc, count(*) AS count FROM clean
            WHERE {zone} AND congestion_surcharge = 0
            GROUP BY pickup_loc ORDER BY count DESC, pickup_loc ASC NULLS FIRST LIMIT {CFG.top_leakage}""",
        "volume_by_quarter": od + """SELECT CAST(year(pickup_time) AS INTEGER) AS year,
            CAST(quarter(pickup_time) AS INTEGER) AS quarter, taxi_type, count(*) AS count
            FROM trips_ord GROUP BY 1, 2, 3""",
        "volume_by_year": od + """SELECT year, taxi_type, CAST(sum(count) AS BIGINT) AS count FROM (
            SELECT CAST(year(pickup_time) AS INTEGER) AS year,
            CAST(quarter(pickup_time) AS INTEGER) AS quarter, taxi_type, count(*) AS count
            FROM trips_ord GROUP BY 1, 2, 3) GROUP BY 1, 2""",
        "velocity_heatmap": _with(TRIPS_EV, _heatmap()) + "SELECT hour, day_of_week, avg_speed FROM heat",
        "velocity_pivot": _with(TRIPS_EV, _heatmap()) + "SELECT day_of_week, "
            + ", ".join(f'max(CASE WHEN hour = {h} THEN avg_speed END) AS "{h}"' for h in range(24))
            + " FROM heat GROUP BY day_of_week",
        "tip_vs_surcharge": _with(TRIPS_LI, _tips()) + "SELECT * FROM tips",
        "tip_series": _with(TRIPS_LI, _tips()) + """SELECT make_date(year, month, 1) AS date,
            avg_surcharge, avg_tip_amount FROM tips""",
        "border_effect": ev + """SELECT dropoff_loc, CAST(year(pickup_time) AS INTEGER) AS year,
            count(*) AS count FROM clean GROUP BY 1, 2""",
        "q1_comparison": od + """SELECT CAST(year(pickup_time) AS INTEGER) AS year,
            CAST(month(pickup_time) AS INTEGER) AS month, taxi_type, count(*) AS count
            FROM trips_ord WHERE month(pickup_time) <= 3 GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
        "daily_trips": od + """SELECT CAST(pickup_time AS DATE) AS date, count(*) AS total_trips
            FROM trips_ord GROUP BY 1""",
        "weather_rows": _with(WEATHER) + f"SELECT date, round(precipitation, {DIG}) AS precipitation FROM weather",
        "rain_join": _with(WEATHER) + f"SELECT date, total_trips, round(precipitation, {DIG}) AS precipitation FROM j",
        "rain_elasticity": _with(WEATHER) + f"""SELECT
            count(*) FILTER (WHERE total_trips IS NOT NULL AND precipitation IS NOT NULL) AS n,
            round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), {DIG}) AS correlation
            FROM (SELECT *,
              CASE WHEN total_trips IS NOT NULL AND precipitation IS NOT NULL THEN CAST(total_trips AS DOUBLE) END AS x,
              CASE WHEN total_trips IS NOT NULL AND precipitation IS NOT NULL THEN precipitation END AS y
              FROM j)""",
        "rain_trend": _with(WEATHER) + f"""SELECT round(regr_slope(y, x), {DIG}) AS slope,
            round(regr_intercept(y, x), {DIG}) AS intercept, round(regr_r2(y, x), {DIG}) AS r2,
            CAST(regr_count(y, x) AS BIGINT) AS n
            FROM (SELECT CAST(total_trips AS DOUBLE) AS y, precipitation AS x FROM j)""",
        "link_harvest": _with(HARVEST) + "SELECT page_id, pos, href, filename FROM harvest",
        "link_filter": _with(HARVEST, _link_map("lm", suite.LINK_YEARS, suite.LINK_FLEETS))
            + "SELECT filename, url FROM lm",
        "link_overlay": _with(
            HARVEST,
            _link_map("base_map", suite.LINK_YEARS, suite.LINK_FLEETS),
            _link_map("upd_map", suite.OVERLAY_YEARS, suite.OVERLAY_FLEETS,
                      f"AND contains(filename, {_q(suite.OVERLAY_TOKEN)})"),
        ) + """SELECT filename, url FROM (
              SELECT *, row_number() OVER (PARTITION BY filename ORDER BY prio DESC) AS rn FROM (
                SELECT filename, url, 0 AS prio FROM base_map
                UNION ALL SELECT filename, url, 1 AS prio FROM upd_map)
            ) WHERE rn = 1""",
        "intake_new": _with(HARVEST, _link_map("lm", suite.LINK_YEARS, suite.LINK_FLEETS)) + f"""
            SELECT lm.filename, lm.url FROM lm WHERE NOT EXISTS (
              SELECT 1 FROM harvest h JOIN pages p ON h.page_id = p.page_id
              WHERE contains(p.url, {_q(suite.EXISTING_SECTION)}) AND h.filename = lm.filename)""",
    }
    out["audit_accounting"] = _audit_sql(AUDIT_ACCOUNTING)
    out["audit_observed"] = _audit_sql(f"""SELECT count(*) AS total,
        count(*) FILTER (WHERE NOT is_ghost) AS clean, count(*) FILTER (WHERE is_ghost) AS audit,
        count(*) FILTER (WHERE is_ghost IS NULL) AS undetermined,
        count(*) FILTER (WHERE speed_mph > {CFG.speed_limit_mph}) AS rule_a,
        count(*) FILTER (WHERE duration_seconds < {CFG.min_trip_seconds} AND fare > {CFG.short_trip_fare}) AS rule_b,
        count(*) FILTER (WHERE trip_distance = 0 AND fare > 0) AS rule_c,
        any_value(n_base_old) AS n_base_old, any_value(n_base_new) AS n_base_new, any_value(n_target) AS n_target,
        any_value(target) AS target, any_value(action) AS action, CAST(0 AS BIGINT) AS ids_lost
        FROM af, decision""")
    out["audit_ghost_vendors"] = out["ghost_vendors"]
    out["audit_compliance"] = ev + f"""SELECT 'events' AS taxi_type, count(*) AS total_zone_trips,
        count(CASE WHEN congestion_surcharge > 0 THEN 1 END) AS paid_surcharge FROM clean WHERE {zone} GROUP BY 1"""
    out["audit_run_leakage"] = out["audit_leakage"]
    out["audit_heatmap"] = out["velocity_heatmap"]
    out["audit_q1"] = ev + """SELECT CAST(year(pickup_time) AS INTEGER) AS year,
        CAST(month(pickup_time) AS INTEGER) AS month, 'events' AS taxi_type, count(*) AS count
        FROM clean WHERE month(pickup_time) <= 3 GROUP BY 1, 2, 3"""
    out["monthly_sources"] = out["source_counts"]
    out["impute_month_leap"] = _impute_month_sql(suite.LEAP_CFG)
    out["impute_month_sampled"] = _impute_month_sql(sampled=True)
    out["mark_zone_table"] = ev + """SELECT event_id, dropoff_loc,
        dropoff_loc IN (SELECT CAST(s_suppkey AS INTEGER) FROM supplier WHERE s_nationkey < 12) AS inside_zone
        FROM clean"""
    out["rain_join_year"] = _with(WEATHER) + f"""SELECT date, total_trips, round(precipitation, {DIG}) AS precipitation
        FROM j WHERE year(date) = {suite.WEATHER_YEAR}"""
    out["parquet_roundtrip"] = out["parquet_sized"] = out["ghost_audit"]
    out |= _run_sql() | _file_sql()
    out["csv_roundtrip"] = out["q1_comparison"]
    return out

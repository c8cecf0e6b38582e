"""Adapters from the shared test tables to the trip data model.

The test warehouse has no trip files, so each adapter derives unified trips
(or a weather feed, or a crawl) from one table with built-in expressions.
All rows of the table are kept; NULLs are injected by arithmetic on the key
because the tables themselves hold none, so the three-valued paths of the
ghost rules are exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripaudit.schema import FleetSpec, conform


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Two tables described as fleets, to drive the fleet reader and unifier; they are passed as
# objects and are not in the registry.
ORDERS_FLEET = FleetSpec(
    "orders",
    {"pickup_time": "o_orderdate", "pickup_loc": "o_custkey", "fare": "o_totalprice"},
    file_glob="orders.parquet",
)
LINEITEM_FLEET = FleetSpec(
    "lineitem",
    {
        "pickup_time": "l_shipdate",
        "pickup_loc": "l_suppkey",
        "dropoff_loc": "l_partkey",
        "trip_distance": "l_quantity",
        "fare": "l_extendedprice",
        "congestion_surcharge": "l_tax",
        "tip_amount": "l_discount",
        "vendor_id": "l_linenumber",
    },
    file_glob="lineitem.parquet",
)
TABLE_FLEETS = (ORDERS_FLEET, LINEITEM_FLEET)


def _null_every(k: int, value) -> F.Column:
    return F.when(F.col("event_id") % k == 0, F.lit(None)).otherwise(value)


def events_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified trips from ``events`` (time of day present), keyed by
    ``event_id``.  Drop-off = ts + ((id*7919) mod 3600 - 30) s, so some
    trips run backwards and some last under a minute."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    trips = ev.select(
        eid,
        F.col("ts").alias("pickup_time"),
        F.timestamp_add("SECOND", (eid * 7919) % 3600 - 30, F.col("ts")).alias("dropoff_time"),
        (F.col("user_id") % 50).cast("int").alias("pickup_loc"),
        _null_every(17, (eid % 265).cast("int")).alias("dropoff_loc"),
        _null_every(13, (eid % 97) / 4).cast("double").alias("trip_distance"),
        _null_every(11, F.col("value")).alias("fare"),
        (F.col("value") * F.lit(1.25)).alias("total_amount"),
        _null_every(7, (eid % 3) * F.lit(1.25)).cast("double").alias("congestion_surcharge"),
        (F.col("user_id") % 6).cast("int").alias("vendor_id"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("yellow"))
         .otherwise(F.lit("green")).alias("taxi_type"),
    )
    return conform(trips, extra=("event_id",))


def orders_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified trips from ``orders``: pickup = order date (no time of day),
    fleet = order status, fare = total price, pickup_loc = customer."""
    o = table(spark, sf_dir, "orders")
    return conform(o.select(
        F.col("o_orderdate").alias("pickup_time"),
        F.col("o_custkey").try_cast("int").alias("pickup_loc"),
        F.col("o_totalprice").alias("fare"),
        F.col("o_orderstatus").alias("taxi_type"),
    ))


def lineitem_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified trips from ``lineitem`` for the money aggregates:
    fare = extended price, total = price * (1 + tax), surcharge = tax."""
    li = table(spark, sf_dir, "lineitem")
    return conform(li.select(
        F.col("l_shipdate").alias("pickup_time"),
        F.col("l_extendedprice").alias("fare"),
        (F.col("l_extendedprice") * (F.lit(1.0) + F.col("l_tax"))).alias("total_amount"),
        F.col("l_tax").alias("congestion_surcharge"),
        F.col("l_returnflag").alias("taxi_type"),
    ))


def ride_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified trips of several years from ``lineitem``, in two fleets ``rides_n`` and
    ``rides_r`` by return flag: a time of day, drop-offs in and out of the zone, surcharges
    paid, unpaid and unknown, and trips that every ghost rule fires on."""
    li = table(spark, sf_dir, "lineitem")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")

    def null_every(k: int, value) -> F.Column:
        return F.when(key % k == 0, F.lit(None)).otherwise(value)

    pickup = F.timestamp_add("SECOND", (key * 613 + line * 7) % 86400, F.col("l_shipdate"))
    fare = F.col("l_extendedprice") / F.lit(997.0)  # no average of these ends at a rounding boundary
    rides = li.select(
        pickup.alias("pickup_time"),
        F.timestamp_add("SECOND", (key * 7919 + line * 104729) % 3600 - 30, pickup).alias("dropoff_time"),
        (F.col("l_suppkey") % 50).cast("int").alias("pickup_loc"),
        null_every(17, (F.col("l_partkey") % 265).cast("int")).alias("dropoff_loc"),
        null_every(13, (key % 97) / 4).cast("double").alias("trip_distance"),
        null_every(11, fare).alias("fare"),
        (fare * F.lit(1.25) + F.col("l_tax")).alias("total_amount"),
        null_every(7, (line % 3) * F.lit(1.25)).cast("double").alias("congestion_surcharge"),
        F.col("l_discount").alias("tip_amount"),
        line.cast("int").alias("vendor_id"),
        F.when(F.col("l_returnflag") == "N", F.lit("rides_n")).otherwise(F.lit("rides_r")).alias("taxi_type"),
    )
    return conform(rides)


def weather_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed weather documents derived from ``lineitem``: average tax per
    ship day, one JSON text per year shaped like the archive API answer
    ``{"daily": {"time": [...], "precipitation_sum": [...]}}``.  A year has
    at most 366 days, so each document is bounded."""
    li = table(spark, sf_dir, "lineitem")
    daily = (li.groupBy(F.to_date("l_shipdate").alias("d"))
             .agg(F.avg("l_tax").alias("p")))
    per_year = (daily.groupBy(F.year("d").alias("year"))
                .agg(F.array_sort(F.collect_list(F.struct("d", "p"))).alias("days")))
    return per_year.select(
        "year",
        F.to_json(F.struct(F.struct(
            F.transform("days", lambda x: F.date_format(x["d"], "yyyy-MM-dd")).alias("time"),
            F.transform("days", lambda x: x["p"]).alias("precipitation_sum"),
        ).alias("daily"))).alias("json"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled pages (page_id, url, html)."""
    return table(spark, sf_dir, "pages")

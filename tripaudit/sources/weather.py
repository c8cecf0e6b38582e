"""Daily weather series from landed archive-API JSON texts (SRC-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Shape of one archive answer; only the two daily arrays are read.
WEATHER_JSON_SCHEMA = T.StructType([
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
    ])),
])


def in_year(weather: DataFrame, year: int | None) -> DataFrame:
    """Days from 1 January to 31 December of ``year``; all days for None."""
    if year is None:
        return weather
    return weather.filter(F.col("date").between(F.lit(dt.date(year, 1, 1)), F.lit(dt.date(year, 12, 31))))


def weather_rows(docs: DataFrame, json_col: str = "json") -> DataFrame:
    """One row per day: ``date DATE, precipitation DOUBLE``; an unreadable day
    is NULL (``unread_days`` counts them).

    The two parallel arrays are zipped position by position (a shorter one
    is padded with NULL); a document without ``daily`` yields no rows.
    Parsing and exploding run per document, in parallel across documents.
    """
    parsed = docs.select(F.from_json(F.col(json_col), WEATHER_JSON_SCHEMA).alias("w"))
    zipped = parsed.select(F.inline(F.arrays_zip(
        F.col("w.daily.time").alias("t"),
        F.col("w.daily.precipitation_sum").alias("p"),
    )))
    # A malformed day string gives a NULL date (never a failed job under ANSI).
    return zipped.select(F.try_to_date("t").alias("date"), F.col("p").alias("precipitation"))


def unread_days(weather: DataFrame) -> DataFrame:
    """One row: days whose date could not be read; no join takes them."""
    return weather.agg(F.count(F.when(F.col("date").isNull(), 1)).alias("unread_days"))


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """Daily series from landed answer files (one JSON document per file,
    e.g. one per year), each read whole and reshaped in parallel."""
    docs = spark.read.option("wholetext", True).text(path)
    return weather_rows(docs, "value")

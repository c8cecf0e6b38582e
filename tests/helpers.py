import datetime as dt

from tripaudit.schema import UNIFIED_SCHEMA


def ts(s: str | None):
    return None if s is None else dt.datetime.fromisoformat(s)


def trips_df(spark, rows):
    """rows: dicts with any unified columns; the rest are NULL."""
    names = [f.name for f in UNIFIED_SCHEMA.fields]
    data = []
    for r in rows:
        r = dict(r)
        for k in ("pickup_time", "dropoff_time"):
            if isinstance(r.get(k), str):
                r[k] = ts(r[k])
        data.append(tuple(r.get(n) for n in names))
    return spark.createDataFrame(data, UNIFIED_SCHEMA)

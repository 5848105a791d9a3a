"""Hand-written rows and plan text."""

import datetime as dt

from pyspark.sql import functions as F

GOOD = {
    "VendorID": 1.0,
    "tpep_pickup_datetime": "2024-01-15 08:30:00",
    "tpep_dropoff_datetime": "2024-01-15 08:45:30",
    "passenger_count": 2.0,
    "trip_distance": 3.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 17.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}

SCHEMA = (
    "id int, VendorID double, tpep_pickup_datetime string, tpep_dropoff_datetime string,"
    " passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string,"
    " PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double,"
    " extra double, mta_tax double, tip_amount double, tolls_amount double,"
    " improvement_surcharge double, total_amount double, congestion_surcharge double,"
    " airport_fee double"
)


def raw_trips(spark, *changes, times="timestamp_ntz"):
    """One row per dict of changes to a good trip; ``id`` is its position."""
    rows = [{"id": i, **GOOD, **c} for i, c in enumerate(changes)]
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA)
    if times == "string":
        return df
    clocks = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return df.withColumns({c: F.col(c).try_cast(times) for c in clocks})


def by_id(df):
    return {r.id: r for r in df.collect()}


def plan_of(df) -> str:
    """Physical plan as text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def same_rows(a, b) -> bool:
    """Equal as bags of rows."""
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

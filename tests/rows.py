"""Hand-written raw trips."""

from datetime import datetime

from pyspark.sql import functions as F

from tierline.trips import RAW_SCHEMA, ZONE_SCHEMA

CLEAN = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2024, 1, 10, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2024, 1, 10, 8, 30, 0),
    "passenger_count": 1,
    "trip_distance": 2.5,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 14.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}

ZONES = [
    (1, "North", "Harbour", "Yellow"),
    (2, "South", "Market", "Boro"),
    (3, "South", "Market", "Boro"),
]


def raw(spark, *changes, schema=RAW_SCHEMA):
    """One row per dict of changes to the clean row."""
    rows = [tuple({**CLEAN, **change}[f.name] for f in schema.fields) for change in changes]
    return spark.createDataFrame(rows, schema)


def many(spark, n, parts=8, **expressions):
    """``n`` rows like the clean row; columns may be SQL expressions over ``id``."""
    columns = {name: F.lit(value) for name, value in CLEAN.items()}
    columns |= {name: F.expr(sql) for name, sql in expressions.items()}
    return spark.range(n, numPartitions=parts).select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields)
    )


def zones(spark, rows=ZONES):
    return spark.createDataFrame(rows, ZONE_SCHEMA)

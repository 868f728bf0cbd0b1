"""Trips and zones derived from the order tables used for testing.

``trips`` turns every line item into a trip with integer arithmetic on its keys,
so that another engine builds the same rows; line items of some orders become
two trips of different vendors, which are the duplicates to be found. ``zones``
are the nations, by region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.sources.tables import conform
from tierline.trips import RAW_SCHEMA, RAW_SCHEMA_OLDER

_MINUTE = "cast((l_orderkey * 37 + l_partkey * 11 + l_linenumber * 101) % 1440 as int)"
_LENGTH = "cast(l_partkey % 61 as int)"
_SHIFT = "l_shipdate + make_ym_interval(if(l_orderkey % 83 = 0, 34, 24), 0)"

_VENDORS = (
    "if(l_orderkey % 50 = 0, "
    "array(l_linenumber % 2 + 1, 2 - l_linenumber % 2), "
    "array(l_linenumber % 2 + 1))"
)

_COLUMNS = {
    "VendorID": f"explode({_VENDORS})",
    "tpep_pickup_datetime": f"{_SHIFT} + make_dt_interval(0, 0, {_MINUTE})",
    "tpep_dropoff_datetime": f"{_SHIFT} + make_dt_interval(0, 0, {_MINUTE} + {_LENGTH})",
    "passenger_count": "if(l_partkey % 23 = 0, null, l_linenumber % 6 + 1)",
    "trip_distance": "if(l_suppkey % 89 = 0, -l_quantity, l_quantity / 4)",
    "RatecodeID": "l_linenumber % 6 + 1",
    "store_and_fwd_flag": (
        "case when l_returnflag = 'R' then 'Y' when l_linenumber = 7 then null else 'N' end"
    ),
    "PULocationID": "if(l_orderkey % 97 = 0, null, l_suppkey % 30)",
    "DOLocationID": "if(l_partkey % 101 = 0, null, l_partkey % 30)",
    "payment_type": "l_linenumber",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount",
    "mta_tax": "l_tax",
    "tip_amount": "l_quantity / 2",
    "tolls_amount": "0.0",
    "improvement_surcharge": "1.0",
    "total_amount": "if(l_orderkey % 53 = 0, -l_extendedprice, l_extendedprice)",
    "congestion_surcharge": "2.5",
    "airport_fee": "if(l_suppkey % 30 = 1, 1.75, 0.0)",
}


def line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips from all line items."""
    return derived_trips(line_items(spark, sf_dir))


def trips_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips, each partition a stretch of pickup times.

    Line items are dealt, which are narrower than trips and need no derivation to be sampled.
    """
    moment = F.expr(_COLUMNS["tpep_pickup_datetime"])
    return derived_trips(used_columns(line_items(spark, sf_dir)).repartitionByRange(moment))


def used_columns(items: DataFrame) -> DataFrame:
    """What trips are derived from."""
    return items.select(*(c for c in items.columns if any(c in sql for sql in _COLUMNS.values())))


def with_vendor(items: DataFrame, vendor: int) -> DataFrame:
    """Line items that have a trip of a vendor."""
    return items.filter(F.expr(f"array_contains({_VENDORS}, {vendor})"))


def derived_trips(items: DataFrame) -> DataFrame:
    """A trip of each line item, two of some."""
    derived = items.select(*(F.expr(sql).alias(name) for name, sql in _COLUMNS.items()))
    return conform(derived, RAW_SCHEMA)


def spread(raw: DataFrame, copies: int, days: int = 182) -> DataFrame:
    """Each trip at ``copies`` moments from January 2024 on, for timing at size.

    Copies differ in day and minute, so they are other trips. Trips beyond the
    valid years keep their time.
    """
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    day = F.pmod(F.unix_date(pickup.cast("date")) + F.col("copy") * 7, F.lit(days))
    moved = F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).cast("timestamp")
    start = (
        moved
        + (pickup - F.date_trunc("day", pickup))
        + F.make_dt_interval(F.lit(0), F.lit(0), F.col("copy"))
    )
    return (
        raw.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        .withColumn("start", F.when(F.year(pickup) > 2025, pickup).otherwise(start))
        .withColumns(
            {
                "tpep_pickup_datetime": F.col("start"),
                "tpep_dropoff_datetime": F.col("start") + (dropoff - pickup),
            }
        )
        .drop("copy", "start")
    )


def trips_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips with the column types of the older files."""
    return conform(trips(spark, sf_dir), RAW_SCHEMA_OLDER)


def misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older trips with numbers that are too large for an id, or no whole numbers."""
    return trips_older(spark, sf_dir).withColumns(
        {
            "VendorID": F.expr("if(payment_type = 1, VendorID + 1099511627776, VendorID)"),
            "DOLocationID": F.expr("if(DOLocationID = 4, 30000000000, DOLocationID)"),
            "passenger_count": F.expr("if(payment_type = 2, passenger_count + 0.5, passenger_count)"),
            "RatecodeID": F.expr(
                "case payment_type when 3 then double('nan') when 4 then 1e300 "
                "when 5 then RatecodeID + 0.25 else RatecodeID end"
            ),
        }
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup from nations and regions."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("SZ_"), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )

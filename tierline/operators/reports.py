"""Questions asked of the gold tables, and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import exact

#: Busiest hours of the working week in one year.
PEAK_HOURS_SQL = """
SELECT pickup_hour, day_of_week_name, total_trips, avg_revenue_per_trip
FROM {table}
WHERE is_weekend = false AND _year = :year
ORDER BY total_trips DESC, day_of_week_num, pickup_hour, _month
LIMIT {n}
"""


def top_zones(
    spark: SparkSession,
    year: int,
    month: int,
    n: int = 10,
    table: str = "daily_revenue_by_zone",
) -> DataFrame:
    """Top ``n`` zones by revenue; the period predicate prunes partitions.

    A zone whose revenue is NaN comes first, as in the order of doubles.
    """
    month_rows = spark.table(table).filter((F.col("_year") == year) & (F.col("_month") == month))
    order = (F.desc("revenue"), "pickup_zone", "pickup_borough")
    return revenue_by_zone(month_rows).orderBy(*order).limit(n)


def peak_weekday_hours(
    spark: SparkSession, year: int, n: int = 10, table: str = "hourly_demand"
) -> DataFrame:
    """Top ``n`` weekday hour slots of a year by trips."""
    return spark.sql(PEAK_HOURS_SQL.format(table=table, n=int(n)), args={"year": year})


def revenue_by_zone(daily: DataFrame) -> DataFrame:
    """Daily table rolled up to zones; NaN and infinity carry through."""
    sums = daily.groupBy("pickup_zone", "pickup_borough").agg(
        F.sum("total_trips").alias("trips"), *exact.partials(["total_revenue"])
    )
    return sums.select(
        "pickup_zone", "pickup_borough", "trips", exact.total("total_revenue").alias("revenue")
    )


# The columns each preview shows.
BRONZE_PREVIEW = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "total_amount",
    "_ingested_at",
    "_source_system",
    "_year",
    "_month",
)
SILVER_PREVIEW = (
    "pickup_datetime",
    "dropoff_datetime",
    "trip_duration_minutes",
    "total_amount",
    "pickup_zone",
    "pickup_borough",
    "dropoff_zone",
    "_silver_processed_at",
)
DAILY_PREVIEW = (
    "pickup_date",
    "pickup_zone",
    "pickup_borough",
    "total_trips",
    "total_revenue",
    "avg_fare",
)
HOURLY_PREVIEW = (
    "day_of_week_name",
    "pickup_hour",
    "total_trips",
    "avg_revenue_per_trip",
    "is_weekend",
)
PAYMENT_PREVIEW = (
    "payment_type_desc",
    "total_trips",
    "total_revenue",
    "avg_tip",
    "tip_rate_pct",
)


def preview(
    df: DataFrame, columns: Sequence[str], n: int, leading: Sequence[Column] = ()
) -> DataFrame:
    """The first ``n`` rows by ``leading`` and then by the shown columns.

    The order leaves nothing open but equal rows, so the preview is repeatable.
    It runs as a top-n: each task keeps ``n`` rows and nothing is sorted in full.
    """
    shown = df.select(*columns)
    return shown.orderBy(*leading, *(F.asc(c) for c in columns)).limit(n)


def preview_bronze(bronze: DataFrame, n: int = 5) -> DataFrame:
    return preview(bronze, BRONZE_PREVIEW, n)


def preview_silver(silver: DataFrame, n: int = 5) -> DataFrame:
    return preview(silver, SILVER_PREVIEW, n)


def preview_daily(daily: DataFrame, n: int = 5) -> DataFrame:
    order = (F.asc("pickup_date"), F.desc("total_revenue"))
    return preview(daily, DAILY_PREVIEW, n, order)


def preview_hourly(hourly: DataFrame, n: int = 5) -> DataFrame:
    return preview(hourly, HOURLY_PREVIEW, n, (F.desc("total_trips"),))


def preview_payments(payments: DataFrame, n: int = 10) -> DataFrame:
    return preview(payments, PAYMENT_PREVIEW, n, (F.desc("total_revenue"),))

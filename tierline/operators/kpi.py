"""The three gold tables.

Each is one hash aggregate over the few columns it needs: map tasks combine
first, so a zone or payment type with a large share of the trips is not a hot
spot, and what is shuffled is the number of groups per map task.

The tables are built from three pruned scans, not from a shared finer table. A
table fine enough for all three (day, hour, zone and payment type) has hundreds
of times more groups per map task than the daily table, and with many map tasks
its shuffle outgrows what reading some columns twice costs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline import trips
from tierline.functions import exact
from tierline.functions.calendar import day_name, run_time

ZONE = ("pickup_zone", "pickup_borough", "pickup_service_zone")


def _grouped(df: DataFrame, keys: dict[str, Column], measures: tuple[str, ...]) -> DataFrame:
    """Group trips by ``keys`` into trip count and the partial columns of measures.

    Date and hour of the pickup are there for use in ``keys``.
    """
    moments = {
        "pickup_date": F.to_date("pickup_datetime"),
        "pickup_hour": F.hour("pickup_datetime"),
    }
    return (
        df.withColumns(moments)
        .groupBy(*(c.alias(name) for name, c in keys.items()))
        .agg(
            F.count(F.lit(1)).alias("total_trips"),
            F.sum("passenger_count").alias("total_passengers"),
            F.max("total_amount").alias("largest_amount"),
            *exact.partials(measures),
        )
    )


def _period() -> dict[str, Column]:
    """Integer period keys, derived from the date."""
    return {"_year": F.year("pickup_date"), "_month": F.month("pickup_date")}


def daily_revenue_by_zone(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Revenue, trips and averages per day and pickup zone.

    Zones are told apart by their names; rows without a zone form a group.
    """
    keys = {name: F.col(name) for name in ("pickup_date", *ZONE)}
    measures = ("total_amount", "fare_amount", "trip_distance", "trip_duration_minutes")
    return (
        _grouped(df, keys, measures)
        .select(
            *keys,
            "total_trips",
            exact.total("total_amount").alias("total_revenue"),
            exact.average("fare_amount").alias("avg_fare"),
            exact.average("trip_distance").alias("avg_trip_distance_miles"),
            exact.average("trip_duration_minutes").alias("avg_trip_duration_mins"),
            "total_passengers",
            F.round("largest_amount", 2).alias("max_single_fare"),
            run_time(run_ts).alias("processed_at"),
            *(c.alias(name) for name, c in _period().items()),
        )
    )


def hourly_demand(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Trips and averages per hour, weekday and month."""
    keys = {
        "pickup_hour": F.col("pickup_hour"),
        "day_of_week_num": F.dayofweek("pickup_date"),
        **_period(),
    }
    measures = ("total_amount", "trip_distance", "passenger_count")
    return (
        _grouped(df, keys, measures)
        .select(
            "pickup_hour",
            "day_of_week_num",
            day_name("day_of_week_num").alias("day_of_week_name"),
            F.col("day_of_week_num").isin(1, 7).alias("is_weekend"),
            "total_trips",
            exact.average("total_amount").alias("avg_revenue_per_trip"),
            exact.average("trip_distance").alias("avg_distance_miles"),
            exact.average("passenger_count", 1).alias("avg_passengers"),
            run_time(run_ts).alias("processed_at"),
            "_year",
            "_month",
        )
    )


def payment_type_summary(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Revenue and tips per payment type and month.

    The tip rate is taken over the rounded totals and is NULL without revenue.
    """
    keys = {"payment_type": F.col("payment_type"), **_period()}
    pairs = (
        F.lit(value).cast(kind)
        for code, name in trips.PAYMENT_NAMES.items()
        for value, kind in ((code, "bigint"), (name, "string"))
    )
    description = F.coalesce(
        F.try_element_at(F.create_map(*pairs), F.col("payment_type")),
        F.lit(trips.OTHER_PAYMENT),
    )
    tip_rate = F.round(F.try_divide(F.col("total_tips"), F.col("total_revenue")) * 100, 2)
    return (
        _grouped(df, keys, ("total_amount", "tip_amount"))
        .select(
            "payment_type",
            description.alias("payment_type_desc"),
            "total_trips",
            exact.total("total_amount").alias("total_revenue"),
            exact.average("total_amount").alias("avg_fare"),
            exact.total("tip_amount").alias("total_tips"),
            exact.average("tip_amount").alias("avg_tip"),
            "_year",
            "_month",
        )
        .withColumns({"tip_rate_pct": tip_rate, "processed_at": run_time(run_ts)})
    )


#: Reading order of each table. It belongs to a result that is looked at; a
#: partitioned write does not keep a global order, so the jobs do not sort.
READING_ORDER = {
    "daily_revenue_by_zone": (("pickup_date", True), ("total_revenue", False)),
    "hourly_demand": (("day_of_week_num", True), ("pickup_hour", True)),
    "payment_type_summary": (("total_revenue", False),),
}

BUILDERS = {
    "daily_revenue_by_zone": daily_revenue_by_zone,
    "hourly_demand": hourly_demand,
    "payment_type_summary": payment_type_summary,
}


#: Columns that tell the rows of each table apart; they settle equal places.
ROW_KEYS = {
    "daily_revenue_by_zone": ("pickup_date", *ZONE),
    "hourly_demand": ("day_of_week_num", "pickup_hour", "_year", "_month"),
    "payment_type_summary": ("payment_type", "_year", "_month"),
}


def in_reading_order(df: DataFrame, table: str) -> DataFrame:
    """Sorted for reading; rows of equal place by their keys, so there is one order."""
    order = READING_ORDER[table]
    keys = [(k, True) for k in ROW_KEYS[table] if k not in dict(order)]
    columns, ascending = zip(*order, *keys)
    return df.orderBy(*columns, ascending=list(ascending))


def with_position(ordered: DataFrame, path: str) -> DataFrame:
    """Number the rows of a sorted frame from 1, in the order they are in.

    Where each row came out of the sort is written to ``path``, as a second run of the
    sort may draw other borders. Rows are numbered within their partitions, and what the
    partitions before hold is added: one number for each partition is all that meets in
    one place.
    """
    placed = ordered.withColumns(
        {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
    )
    placed.write.parquet(path)
    placed = ordered.sparkSession.read.schema(placed.schema).parquet(path)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_at"))
    numbered = placed.withColumn("_within", within).join(starts, "_part")
    position = (F.col("_before") + F.col("_within")).alias("position")
    return numbered.select(*ordered.columns, position)

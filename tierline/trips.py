"""Everything that is specific to taxi-trip tables.

The operators of this package take column names, rules and schemas as
arguments; their defaults come from here, so another event table needs another
module like this one and no new operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table schemas, names, codes and limits of the trip data.
# They decide the results and must stay as they are.
# ---------------------------------------------------------------------------

MONEY_AND_FEES = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def table_schema(**columns: str) -> T.StructType:
    """Schema of nullable columns; needs no session, so it can be a constant."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


def _raw_schema(id_type: str, count_type: str) -> T.StructType:
    return table_schema(
        VendorID=id_type,
        tpep_pickup_datetime="timestamp",
        tpep_dropoff_datetime="timestamp",
        passenger_count=count_type,
        trip_distance="double",
        RatecodeID=count_type,
        store_and_fwd_flag="string",
        PULocationID=id_type,
        DOLocationID=id_type,
        payment_type="bigint",
        **{name: "double" for name in MONEY_AND_FEES},
    )


#: Raw trips as they are published now.
RAW_SCHEMA = _raw_schema(id_type="int", count_type="bigint")
#: Raw trips of the older files: wide ids, counts stored as doubles.
RAW_SCHEMA_OLDER = _raw_schema(id_type="bigint", count_type="double")

ZONE_SCHEMA = table_schema(
    LocationID="int", Borough="string", Zone="string", service_zone="string"
)

SOURCE_SYSTEM = "nyc_tlc"
SILVER_VERSION = "1.0"

#: Columns watched by the null-rate gate, and the highest null share it accepts.
CRITICAL_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "total_amount",
)
NULL_RATE_LIMIT = 0.20

#: Raw name -> silver name; columns not listed keep their name.
RENAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

MIN_PICKUP_YEAR = 2019
MAX_PICKUP_YEAR = 2025

#: Two rows that agree on all of these are the same trip.
TRIP_KEY = (
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
    "total_amount",
)

#: Silver columns that follow from the key, so equal for copies of a trip.
FROM_TRIP_KEY = ("trip_duration_minutes", "_year", "_month")

#: ``dayofweek`` numbers these from 1.
DAY_NAMES = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)

PAYMENT_NAMES = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
OTHER_PAYMENT = "Other"

PERIOD = ("_year", "_month")

# ---------------------------------------------------------------------------
# Quality rules
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """A reason to reject a row: ``breach`` is a SQL predicate over silver names.

    A NULL predicate does not reject, so a missing value passes every rule that
    does not ask for NULL itself.
    """

    name: str
    breach: str


def quality_rules(
    min_year: int = MIN_PICKUP_YEAR,
    max_year: int = MAX_PICKUP_YEAR,
    required: tuple[str, ...] = (),
) -> tuple[Rule, ...]:
    """The trip rules in reporting order.

    ``required`` names further columns that may not be NULL; each adds a rule
    ``null_<column>`` after the standard six.
    """
    return (
        Rule(
            f"pickup_year_out_of_range({min_year}-{max_year})",
            f"year(pickup_datetime) NOT BETWEEN {min_year} AND {max_year}",
        ),
        Rule("negative_trip_distance", "trip_distance < 0"),
        Rule("negative_total_amount", "total_amount < 0"),
        Rule("null_pickup_location", "pickup_location_id IS NULL"),
        Rule("null_dropoff_location", "dropoff_location_id IS NULL"),
        Rule("non_positive_duration", "trip_duration_minutes <= 0"),
        *(Rule(f"null_{name}", f"`{name}` IS NULL") for name in required),
    )


# ---------------------------------------------------------------------------
# Schemas of the stored layers
# ---------------------------------------------------------------------------

_LINEAGE = table_schema(
    _ingested_at="timestamp", _source_system="string", _source_path="string"
).fields
_PERIOD = table_schema(_year="string", _month="string").fields

BRONZE_SCHEMA = T.StructType(RAW_SCHEMA.fields + _LINEAGE + _PERIOD)


def _standardised_fields() -> list[T.StructField]:
    """Raw and lineage columns under their silver names and types."""
    retyped = {"store_and_fwd_flag": T.BooleanType(), "passenger_count": T.IntegerType()}
    fields = [
        T.StructField(RENAMES.get(f.name, f.name), retyped.get(f.name, f.dataType))
        for f in RAW_SCHEMA.fields
    ]
    return fields + _LINEAGE + table_schema(trip_duration_minutes="double").fields


QUARANTINE_SCHEMA = T.StructType(
    _standardised_fields() + table_schema(dq_issues="string", is_valid="boolean").fields + _PERIOD
)


def _silver_schema() -> T.StructType:
    # The lookup joins put their key columns first.
    front = ("dropoff_location_id", "pickup_location_id")
    fields = {f.name: f for f in _standardised_fields()}
    ordered = [fields.pop(name) for name in front] + list(fields.values())
    zones = {
        f"{role}_{name}": "string"
        for role in ("pickup", "dropoff")
        for name in ("borough", "zone", "service_zone")
    }
    added = table_schema(**zones, _silver_processed_at="timestamp", _silver_version="string")
    return T.StructType(ordered + added.fields + _PERIOD)


SILVER_SCHEMA = _silver_schema()

#: The gold tables by name, as stored and as registered in the catalog.
GOLD_TABLES = {
    "daily_revenue_by_zone": table_schema(
        pickup_date="date",
        pickup_zone="string",
        pickup_borough="string",
        pickup_service_zone="string",
        total_trips="bigint",
        total_revenue="double",
        avg_fare="double",
        avg_trip_distance_miles="double",
        avg_trip_duration_mins="double",
        total_passengers="bigint",
        max_single_fare="double",
        processed_at="timestamp",
        _year="int",
        _month="int",
    ),
    "hourly_demand": table_schema(
        pickup_hour="int",
        day_of_week_num="int",
        day_of_week_name="string",
        is_weekend="boolean",
        total_trips="bigint",
        avg_revenue_per_trip="double",
        avg_distance_miles="double",
        avg_passengers="double",
        processed_at="timestamp",
        _year="int",
        _month="int",
    ),
    "payment_type_summary": table_schema(
        payment_type="bigint",
        payment_type_desc="string",
        total_trips="bigint",
        total_revenue="double",
        avg_fare="double",
        total_tips="double",
        avg_tip="double",
        tip_rate_pct="double",
        processed_at="timestamp",
        _year="int",
        _month="int",
    ),
}

"""Plain SQL for each registered query, for an engine other than Spark.

The statements share a chain of common table expressions; each query starts with
as much of the chain as it needs. Averages and sums are taken over whole numbers
of 1/10000 units and 1/100 units, so that no rounding depends on the engine.
"""

from __future__ import annotations

RUN_TS = "2024-07-01 00:00:00"
SOURCE_PATH = "raw/trips"
RERUN_YEAR, RERUN_MONTH = "2022", "03"
_RERUN = f"coalesce(_year = '{RERUN_YEAR}' AND _month = '{RERUN_MONTH}', false)"

_LEG = """
leg AS (
  SELECT
    CAST(l_linenumber % 2 + 1 AS INTEGER) AS VendorID,
    l_shipdate + to_years(CASE WHEN l_orderkey % 83 = 0 THEN 34 ELSE 24 END)
      + to_minutes((l_orderkey * 37 + l_partkey * 11 + l_linenumber * 101) % 1440)
      AS tpep_pickup_datetime,
    l_shipdate + to_years(CASE WHEN l_orderkey % 83 = 0 THEN 34 ELSE 24 END)
      + to_minutes((l_orderkey * 37 + l_partkey * 11 + l_linenumber * 101) % 1440
                   + l_partkey % 61)
      AS tpep_dropoff_datetime,
    CASE WHEN l_partkey % 23 = 0 THEN NULL
         ELSE CAST(l_linenumber % 6 + 1 AS BIGINT) END AS passenger_count,
    CASE WHEN l_suppkey % 89 = 0 THEN -l_quantity ELSE l_quantity / 4 END AS trip_distance,
    CAST(l_linenumber % 6 + 1 AS BIGINT) AS RatecodeID,
    CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_linenumber = 7 THEN NULL ELSE 'N' END
      AS store_and_fwd_flag,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_suppkey % 30 AS INTEGER) END
      AS PULocationID,
    CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE CAST(l_partkey % 30 AS INTEGER) END
      AS DOLocationID,
    CAST(l_linenumber AS BIGINT) AS payment_type,
    l_extendedprice AS fare_amount,
    l_discount AS extra,
    l_tax AS mta_tax,
    l_quantity / 2 AS tip_amount,
    CAST(0.0 AS DOUBLE) AS tolls_amount,
    CAST(1.0 AS DOUBLE) AS improvement_surcharge,
    CASE WHEN l_orderkey % 53 = 0 THEN -l_extendedprice ELSE l_extendedprice END
      AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge,
    CASE WHEN l_suppkey % 30 = 1 THEN CAST(1.75 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
      AS airport_fee,
    l_orderkey % 50 = 0 AS twice
  FROM lineitem
)"""

_TRIPS = """
trips AS (
  SELECT * EXCLUDE (twice) FROM leg
  UNION ALL
  SELECT * EXCLUDE (twice) REPLACE (3 - VendorID AS VendorID) FROM leg WHERE twice
)"""

_ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         'SZ_' || CAST(n_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def _period(moment: str) -> str:
    return (
        f"CAST(year({moment}) AS VARCHAR) AS _year, "
        f"lpad(CAST(month({moment}) AS VARCHAR), 2, '0') AS _month"
    )


_BRONZE = f"""
bronze AS (
  SELECT *, TIMESTAMP '{RUN_TS}' AS _ingested_at, 'nyc_tlc' AS _source_system,
         '{SOURCE_PATH}' AS _source_path, {_period("tpep_pickup_datetime")}
  FROM trips
)"""

_STANDARDISED = """
standardised AS (
  SELECT
    VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime,
    CAST(coalesce(passenger_count, 0) AS INTEGER) AS passenger_count,
    trip_distance, RatecodeID AS rate_code_id,
    coalesce(store_and_fwd_flag = 'Y', false) AS store_and_fwd_flag,
    PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
    payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
    _ingested_at, _source_system, _source_path, _year, _month,
    round(CAST(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE)
          / CAST(60 AS DOUBLE), 2) AS trip_duration_minutes
  FROM bronze
)"""

_TAGGED = """
tagged AS (
  SELECT *, dq_issues = '' AS is_valid FROM (
    SELECT *, concat_ws(', ',
      CASE WHEN year(pickup_datetime) NOT BETWEEN 2019 AND 2025
           THEN 'pickup_year_out_of_range(2019-2025)' END,
      CASE WHEN trip_distance < 0 THEN 'negative_trip_distance' END,
      CASE WHEN total_amount < 0 THEN 'negative_total_amount' END,
      CASE WHEN pickup_location_id IS NULL THEN 'null_pickup_location' END,
      CASE WHEN dropoff_location_id IS NULL THEN 'null_dropoff_location' END,
      CASE WHEN trip_duration_minutes <= 0 THEN 'non_positive_duration' END) AS dq_issues
    FROM standardised)
)"""

_TIES = (
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "rate_code_id",
    "store_and_fwd_flag",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "airport_fee",
)

_DEDUPED = f"""
deduped AS (
  SELECT * EXCLUDE (dq_issues, is_valid, place) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY pickup_datetime, dropoff_datetime, pickup_location_id,
                   dropoff_location_id, total_amount
      ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _TIES)}) AS place
    FROM tagged WHERE is_valid)
  WHERE place = 1
)"""

_ENRICHED = """
enriched AS (
  SELECT d.*, p.Borough AS pickup_borough, p.Zone AS pickup_zone,
         p.service_zone AS pickup_service_zone, q.Borough AS dropoff_borough,
         q.Zone AS dropoff_zone, q.service_zone AS dropoff_service_zone
  FROM deduped d
  LEFT JOIN zones p ON d.pickup_location_id = p.LocationID
  LEFT JOIN zones q ON d.dropoff_location_id = q.LocationID
)"""

_SILVER = f"""
silver AS (
  SELECT * EXCLUDE (_year, _month), TIMESTAMP '{RUN_TS}' AS _silver_processed_at,
         '1.0' AS _silver_version, {_period("pickup_datetime")}
  FROM enriched
)"""


def _sum(column: str) -> str:
    """Sum of values with two digits, exact."""
    units = f"sum(CAST(round({column} * 100) AS HUGEINT))"
    return f"CAST({units} AS DOUBLE) / CAST(100 AS DOUBLE)"


def _avg(column: str, digits: int = 2) -> str:
    """Average of values that are not negative, rounded half up, exact."""
    k = 10 ** (4 - digits)
    units = f"sum(CAST(round({column} * 10000) AS HUGEINT))"
    whole = f"(2 * {units} + {k} * count({column})) // (2 * {k} * count({column}))"
    return f"CAST({whole} AS DOUBLE) / CAST({10 ** digits} AS DOUBLE)"


_PERIOD_KEYS = "CAST(_year AS INTEGER) AS _year, CAST(_month AS INTEGER) AS _month"
_PROCESSED = f"TIMESTAMP '{RUN_TS}' AS processed_at"

_DAILY = f"""
daily AS (
  SELECT CAST(pickup_datetime AS DATE) AS pickup_date, pickup_zone, pickup_borough,
         pickup_service_zone, count(*) AS total_trips,
         {_sum("total_amount")} AS total_revenue, {_avg("fare_amount")} AS avg_fare,
         {_avg("trip_distance")} AS avg_trip_distance_miles,
         {_avg("trip_duration_minutes")} AS avg_trip_duration_mins,
         CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
         max(total_amount) AS max_single_fare, {_PROCESSED}, {_PERIOD_KEYS}
  FROM silver
  GROUP BY CAST(pickup_datetime AS DATE), pickup_zone, pickup_borough,
           pickup_service_zone, silver._year, silver._month
)"""

_HOURLY = f"""
hourly AS (
  SELECT CAST(pickup_hour AS INTEGER) AS pickup_hour,
         CAST(dow + 1 AS INTEGER) AS day_of_week_num,
         CASE dow WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
                  WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday'
                  ELSE 'Saturday' END AS day_of_week_name,
         dow IN (0, 6) AS is_weekend, count(*) AS total_trips,
         {_avg("total_amount")} AS avg_revenue_per_trip,
         {_avg("trip_distance")} AS avg_distance_miles,
         {_avg("passenger_count", 1)} AS avg_passengers, {_PROCESSED}, {_PERIOD_KEYS}
  FROM (SELECT *, hour(pickup_datetime) AS pickup_hour, dayofweek(pickup_datetime) AS dow
        FROM silver) s
  GROUP BY pickup_hour, dow, s._year, s._month
)"""

_PAYMENT = f"""
payment AS (
  SELECT *, round(total_tips / nullif(total_revenue, 0) * 100, 2) AS tip_rate_pct FROM (
    SELECT payment_type,
           CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash'
                WHEN 3 THEN 'No Charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown'
                WHEN 6 THEN 'Voided Trip' ELSE 'Other' END AS payment_type_desc,
           count(*) AS total_trips, {_sum("total_amount")} AS total_revenue,
           {_avg("total_amount")} AS avg_fare, {_sum("tip_amount")} AS total_tips,
           {_avg("tip_amount")} AS avg_tip, {_PROCESSED}, {_PERIOD_KEYS}
    FROM silver
    GROUP BY payment_type, silver._year, silver._month)
)"""

_CHAIN = {
    "leg": _LEG,
    "trips": _TRIPS,
    "zones": _ZONES,
    "bronze": _BRONZE,
    "standardised": _STANDARDISED,
    "tagged": _TAGGED,
    "deduped": _DEDUPED,
    "enriched": _ENRICHED,
    "silver": _SILVER,
    "daily": _DAILY,
    "hourly": _HOURLY,
    "payment": _PAYMENT,
}


def _after(last: str, query: str) -> str:
    """``query`` behind the chain up to and including ``last``."""
    names = list(_CHAIN)
    used = [_CHAIN[name] for name in names[: names.index(last) + 1]]
    return f"WITH {','.join(used)}\n{query}"


_REVENUE_BY_ZONE = f"""
SELECT pickup_zone, pickup_borough, CAST(sum(total_trips) AS BIGINT) AS trips,
       {_sum("total_revenue")} AS revenue
FROM daily"""


def _gate_line(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count(*) AS total_rows, "
        f"count(*) - count({column}) AS null_rows, "
        f"CAST(count(*) - count({column}) AS DOUBLE) / count(*) AS null_rate, "
        f"CAST(count(*) - count({column}) AS DOUBLE) / count(*) <= 0.20 AS passed FROM trips"
    )


_GATE = "\nUNION ALL ".join(
    _gate_line(c)
    for c in (
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "PULocationID",
        "DOLocationID",
        "total_amount",
    )
)

_STAGES = {
    "raw": "trips",
    "bronze": "bronze",
    "valid": "tagged WHERE is_valid",
    "rejected": "tagged WHERE NOT is_valid",
    "silver": "silver",
    "daily_revenue_by_zone": "daily",
    "hourly_demand": "hourly",
    "payment_type_summary": "payment",
}
_STAGE_COUNTS = "\nUNION ALL ".join(
    f"SELECT '{stage}' AS stage, count(*) AS n_rows FROM {source}"
    for stage, source in _STAGES.items()
)

_GOLD_PERIODS = "\nUNION ALL ".join(
    f"SELECT '{table}' AS table_name, _year, _month, count(*) AS n_rows, "
    f"CAST(sum(total_trips) AS BIGINT) AS trips FROM {source} GROUP BY _year, _month"
    for table, source in (
        ("daily_revenue_by_zone", "daily"),
        ("hourly_demand", "hourly"),
        ("payment_type_summary", "payment"),
    )
)


_LEDGER = """
, months AS (
  SELECT b._year, b._month, b.n, t.valid, t.rejected, coalesce(s.n, 0) AS silver
  FROM (SELECT _year, _month, count(*) AS n FROM bronze GROUP BY ALL) b
  JOIN (SELECT _year, _month, count(*) FILTER (WHERE is_valid) AS valid,
               count(*) FILTER (WHERE NOT is_valid) AS rejected
        FROM tagged GROUP BY ALL) t USING (_year, _month)
  LEFT JOIN (SELECT _year, _month, count(*) AS n FROM silver GROUP BY ALL) s USING (_year, _month)
)
""" + "\nUNION ALL ".join(
    ["SELECT 'bronze' AS layer, _year, _month, n AS n_rows, CAST(NULL AS DOUBLE) AS share FROM months"]
    + [
        f"SELECT '{layer}', _year, _month, {layer}, CAST({layer} AS DOUBLE) / n FROM months"
        for layer in ("valid", "rejected", "silver")
    ]
    + [
        f"SELECT '{layer}', NULL, NULL, count(*), NULL FROM {source}"
        for layer, source in (
            ("raw", "trips"),
            ("daily_revenue_by_zone", "daily"),
            ("hourly_demand", "hourly"),
            ("payment_type_summary", "payment"),
        )
    ]
)

_TIPS_AGAIN = "tip_amount + 1"
_STRAYS = f"""
SELECT place, _year, _month, count(*) AS n_rows, sum(tips) AS tips FROM (
  SELECT 'bronze' AS place, _year, _month,
         CASE WHEN {_RERUN} THEN {_TIPS_AGAIN} ELSE tip_amount END AS tips FROM bronze
  UNION ALL
  SELECT 'strays' AS place, _year, _month, {_TIPS_AGAIN} AS tips FROM bronze WHERE NOT ({_RERUN}))
GROUP BY place, _year, _month"""


def _losses(column: str, nulled: str, changed: str) -> str:
    """Lost values of the older files, which hold the trips of vendor 2."""
    return (
        f"SELECT '{column}' AS column_name, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE VendorID = 2 AND {nulled}) AS nulled, "
        f"count(*) FILTER (WHERE VendorID = 2 AND {changed}) AS changed FROM trips"
    )


_CASTS = "\nUNION ALL ".join(
    _losses(*line)
    for line in (
        ("VendorID", "payment_type = 1", "false"),
        ("passenger_count", "false", "payment_type = 2 AND passenger_count IS NOT NULL"),
        ("RatecodeID", "payment_type = 4", "payment_type = 5"),
        ("PULocationID", "false", "false"),
        ("DOLocationID", "DOLocationID = 4", "false"),
    )
)

# The types of both generations of files.
_TYPES_OF_FILES = {
    "VendorID": ("int", "bigint"),
    "tpep_pickup_datetime": ("timestamp", "timestamp"),
    "tpep_dropoff_datetime": ("timestamp", "timestamp"),
    "passenger_count": ("bigint", "double"),
    "trip_distance": ("double", "double"),
    "RatecodeID": ("bigint", "double"),
    "store_and_fwd_flag": ("string", "string"),
    "PULocationID": ("int", "bigint"),
    "DOLocationID": ("int", "bigint"),
    "payment_type": ("bigint", "bigint"),
    "fare_amount": ("double", "double"),
    "extra": ("double", "double"),
    "mta_tax": ("double", "double"),
    "tip_amount": ("double", "double"),
    "tolls_amount": ("double", "double"),
    "improvement_surcharge": ("double", "double"),
    "total_amount": ("double", "double"),
    "congestion_surcharge": ("double", "double"),
    "airport_fee": ("double", "double"),
}
#: Vendor 1 is in three current files, vendor 2 in two older ones.
_CENSUS = (
    "SELECT column_name, type, CAST(sum(files) AS BIGINT) AS n_files, CAST(sum(n) AS BIGINT) AS n_rows FROM (\n"
    + "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS type, {files} AS files, "
        f"(SELECT count(*) FROM trips WHERE VendorID = {vendor}) AS n"
        for name, kinds in _TYPES_OF_FILES.items()
        for vendor, (kind, files) in enumerate(zip(kinds, (3, 2)), 1)
    )
    + ")\nGROUP BY column_name, type"
)


def statements() -> dict[str, str]:
    daily = _after("daily", "SELECT * FROM daily")
    hourly = _after("hourly", "SELECT * FROM hourly")
    payment = _after("payment", "SELECT * FROM payment")
    silver = _after("silver", "SELECT * FROM silver")
    rejected = _after("tagged", "SELECT * FROM tagged WHERE NOT is_valid")
    return {
        "typed_scan": _after("trips", "SELECT * FROM trips"),
        "zone_lookup_csv": _after("zones", "SELECT * FROM zones"),
        "bronze_lineage": _after("bronze", "SELECT * FROM bronze"),
        "bronze_null_gate": _after("trips", _GATE),
        "bronze_roundtrip": _after(
            "bronze",
            f"""
SELECT _year, _month, count(*) AS n_rows,
       sum(tip_amount + CASE WHEN _year = '{RERUN_YEAR}' AND _month = '{RERUN_MONTH}'
                             THEN 1 ELSE 0 END) AS tips
FROM bronze GROUP BY _year, _month""",
        ),
        "bronze_with_strays": _after("bronze", _STRAYS),
        "cast_audit": _after("trips", _CASTS),
        "schema_census": _after("trips", _CENSUS),
        "standardised": _after("standardised", "SELECT * FROM standardised"),
        "dq_tagged": _after("tagged", "SELECT * FROM tagged"),
        "dq_issue_counts": _after(
            "tagged", "SELECT dq_issues, count(*) AS n_rows FROM tagged GROUP BY dq_issues"
        ),
        "dq_split_summary": _after(
            "tagged",
            """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_valid) AS valid_rows,
       count(*) FILTER (WHERE NOT is_valid) AS rejected_rows,
       CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) AS valid_share,
       CAST(count(*) FILTER (WHERE NOT is_valid) AS DOUBLE) / count(*) AS rejected_share
FROM tagged""",
        ),
        "quarantine": rejected,
        "quarantine_roundtrip": rejected,
        "dedup": _after("deduped", "SELECT * FROM deduped"),
        "enriched": _after("enriched", "SELECT * FROM enriched"),
        "enriched_by_shuffle": _after("enriched", "SELECT * FROM enriched"),
        "silver": silver,
        "silver_roundtrip": silver,
        "daily_revenue_by_zone": daily,
        "hourly_demand": hourly,
        "payment_type_summary": payment,
        "daily_stored": daily,
        "hourly_stored": hourly,
        "payment_stored": payment,
        "daily_positions": _after(
            "daily",
            """
SELECT pickup_date, pickup_zone, pickup_borough, pickup_service_zone, row_number() OVER (
  ORDER BY pickup_date, total_revenue DESC, pickup_zone NULLS FIRST, pickup_borough NULLS FIRST,
           pickup_service_zone NULLS FIRST) AS position
FROM daily""",
        ),
        "hourly_positions": _after(
            "hourly",
            """
SELECT day_of_week_num, pickup_hour, _year, _month, row_number() OVER (
  ORDER BY day_of_week_num, pickup_hour, _year, _month) AS position
FROM hourly""",
        ),
        "payment_positions": _after(
            "payment",
            """
SELECT payment_type, _year, _month, row_number() OVER (
  ORDER BY total_revenue DESC, payment_type, _year, _month) AS position
FROM payment""",
        ),
        "gold_roundtrip": _after("payment", _GOLD_PERIODS),
        "revenue_by_zone": _after(
            "daily", f"{_REVENUE_BY_ZONE} GROUP BY pickup_zone, pickup_borough"
        ),
        "top_zones_by_revenue": _after(
            "daily",
            f"""{_REVENUE_BY_ZONE}
WHERE _year = {int(RERUN_YEAR)} AND _month = {int(RERUN_MONTH)}
GROUP BY pickup_zone, pickup_borough
ORDER BY revenue DESC, pickup_zone NULLS FIRST, pickup_borough NULLS FIRST LIMIT 10""",
        ),
        "peak_weekday_hours": _after(
            "hourly",
            f"""
SELECT pickup_hour, day_of_week_name, total_trips, avg_revenue_per_trip
FROM hourly WHERE NOT is_weekend AND _year = {int(RERUN_YEAR)}
ORDER BY total_trips DESC, day_of_week_num, pickup_hour, _month LIMIT 10""",
        ),
        "hourly_top5": _after(
            "hourly",
            """
SELECT day_of_week_name, pickup_hour, total_trips, avg_revenue_per_trip, is_weekend
FROM hourly
ORDER BY total_trips DESC, day_of_week_name, pickup_hour, avg_revenue_per_trip LIMIT 5""",
        ),
        "preview_bronze": _after(
            "bronze",
            """
SELECT tpep_pickup_datetime, PULocationID, DOLocationID, total_amount, _ingested_at,
       _source_system, _year, _month
FROM bronze
ORDER BY tpep_pickup_datetime, PULocationID NULLS FIRST, DOLocationID NULLS FIRST,
         total_amount LIMIT 5""",
        ),
        "preview_silver": _after(
            "silver",
            """
SELECT pickup_datetime, dropoff_datetime, trip_duration_minutes, total_amount,
       pickup_zone, pickup_borough, dropoff_zone, _silver_processed_at
FROM silver
ORDER BY pickup_datetime, dropoff_datetime, total_amount, pickup_zone NULLS FIRST,
         pickup_borough NULLS FIRST, dropoff_zone NULLS FIRST LIMIT 5""",
        ),
        "preview_daily": _after(
            "daily",
            """
SELECT pickup_date, pickup_zone, pickup_borough, total_trips, total_revenue, avg_fare
FROM daily
ORDER BY pickup_date, total_revenue DESC, pickup_zone NULLS FIRST LIMIT 5""",
        ),
        "preview_payments": _after(
            "payment",
            """
SELECT payment_type_desc, total_trips, total_revenue, avg_tip, tip_rate_pct
FROM payment
ORDER BY total_revenue DESC, payment_type_desc, total_trips LIMIT 10""",
        ),
        "period_rerun": daily,
        "rejected_month": _after(
            "silver",
            f"""
SELECT layer, _year, _month, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT 'silver' AS layer, _year, _month FROM silver
  WHERE NOT ({_RERUN})
  UNION ALL
  SELECT 'gold' AS layer, _year, _month FROM silver
  WHERE NOT ({_RERUN})
  UNION ALL
  SELECT 'quarantine' AS layer, _year, _month FROM tagged WHERE NOT is_valid OR ({_RERUN}))
GROUP BY layer, _year, _month""",
        ),
        "fine_decimals": """
SELECT l_returnflag, l_linestatus,
       CAST((2 * s + 10000) // 20000 AS DOUBLE) / 100 AS total,
       CAST((2 * s + 100 * n) // (200 * n) AS DOUBLE) / 10000 AS average
FROM (SELECT l_returnflag, l_linestatus, CAST(sum(l_partkey) AS HUGEINT) AS s,
             CAST(count(*) AS HUGEINT) AS n
      FROM lineitem GROUP BY l_returnflag, l_linestatus)""",
        "stage_counts": _after("payment", _STAGE_COUNTS),
        "run_ledger": _after("payment", _LEDGER),
    }

"""Edge cases of the gold tables, the reports and registration."""

import math
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rows import many, raw, zones
from tierline import session, trips
from tierline.operators import kpi, reports
from tierline.operators.enrich import enrich_with_zones
from tierline.operators.standardise import standardise, with_silver_metadata
from tierline.sinks.catalog import register_gold
from tierline.sinks.tables import write_gold
from tierline.sources.tables import read_gold
from tierline.trips import GOLD_TABLES

RUN = datetime(2024, 7, 1)


def silver(spark, df):
    return with_silver_metadata(enrich_with_zones(standardise(df), zones(spark)), RUN)


@pytest.mark.parametrize("table", list(GOLD_TABLES))
def test_columns_and_types(spark, table):
    built = kpi.BUILDERS[table](silver(spark, raw(spark, {})), RUN)
    want = {(f.name, f.dataType) for f in GOLD_TABLES[table].fields}
    assert {(f.name, f.dataType) for f in built.schema.fields} == want


def test_daily_groups_by_zone_names(spark):
    df = silver(
        spark,
        raw(
            spark,
            {"PULocationID": 2, "total_amount": 10.0},
            {"PULocationID": 3, "total_amount": 20.5, "passenger_count": None},
            {"PULocationID": 99},
            {"PULocationID": None},
        ),
    )
    rows = {r["pickup_zone"]: r for r in kpi.daily_revenue_by_zone(df, RUN).collect()}
    assert set(rows) == {"Market", None}
    market = rows["Market"]
    assert market["pickup_date"] == date(2024, 1, 10)
    assert (market["total_trips"], market["total_revenue"], market["max_single_fare"]) == (2, 30.5, 20.5)
    assert (market["total_passengers"], market["avg_trip_duration_mins"]) == (1, 30.0)
    assert (market["_year"], market["_month"], market["processed_at"]) == (2024, 1, RUN)
    assert rows[None]["total_trips"] == 2


def test_hourly_weekdays(spark):
    """2024-01-06 is a Saturday."""
    starts = [datetime(2024, 1, 6, 23) + timedelta(days=d) for d in range(3)]
    changes = [
        {"tpep_pickup_datetime": s, "tpep_dropoff_datetime": s + timedelta(hours=2)} for s in starts
    ]
    changes.append({"tpep_pickup_datetime": None, "passenger_count": None})
    rows = kpi.hourly_demand(silver(spark, raw(spark, *changes)), RUN).collect()
    got = {
        (r["day_of_week_num"], r["day_of_week_name"], r["is_weekend"], r["pickup_hour"], r["_month"])
        for r in rows
    }
    assert got == {
        (7, "Saturday", True, 23, 1),
        (1, "Sunday", True, 23, 1),
        (2, "Monday", False, 23, 1),
        (None, "Saturday", None, None, None),
    }
    assert {r["avg_passengers"] for r in rows if r["day_of_week_num"] is None} == {0.0}


def test_averages_count_missing_passengers_as_zero(spark):
    df = silver(spark, raw(spark, {"passenger_count": 1}, {"passenger_count": None}, {"passenger_count": 3}))
    assert kpi.hourly_demand(df, RUN).first()["avg_passengers"] == 1.3


def test_payment_names_and_tip_rate(spark):
    changes = [{"payment_type": code} for code in (None, 0, 1, 2, 3, 4, 5, 6, 7)]
    changes[2] |= {"tip_amount": 1.0, "total_amount": 3.0}
    changes[3] |= {"tip_amount": 1.0, "total_amount": 0.0}
    rows = kpi.payment_type_summary(silver(spark, raw(spark, *changes)), RUN).collect()
    assert {(r["payment_type"], r["payment_type_desc"]) for r in rows} == {
        (None, "Other"),
        (0, "Other"),
        (1, "Credit Card"),
        (2, "Cash"),
        (3, "No Charge"),
        (4, "Dispute"),
        (5, "Unknown"),
        (6, "Voided Trip"),
        (7, "Other"),
    }
    rates = {r["payment_type"]: r["tip_rate_pct"] for r in rows}
    assert (rates[1], rates[2]) == (33.33, None)


def test_reading_order(spark):
    df = silver(spark, many(spark, 60, PULocationID="id % 4", payment_type="id % 5", total_amount="id"))
    daily = kpi.in_reading_order(kpi.daily_revenue_by_zone(df, RUN), "daily_revenue_by_zone")
    revenue = [r["total_revenue"] for r in daily.collect()]
    assert revenue == sorted(revenue, reverse=True) and len(revenue) == 3


@pytest.mark.parametrize("parts", [1, 16])
def test_tables_do_not_depend_on_partitioning(spark, parts):
    df = silver(
        spark,
        many(spark, 5000, total_amount="id / 100", fare_amount="id / 1000", PULocationID="id % 4"),
    )
    for build in kpi.BUILDERS.values():
        a, b = build(df, RUN), build(df.repartition(parts), RUN)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_registered_tables_answer_sql(spark, tmp_path):
    root = str(tmp_path / "it's gold")
    month = "make_timestamp(2024, 1 + id % 3, 10, id % 24, 0, 0)"
    df = silver(
        spark,
        many(
            spark,
            600,
            tpep_pickup_datetime=month,
            tpep_dropoff_datetime=f"{month} + interval 10 minutes",
            PULocationID="id % 4",
        ),
    )
    for table, build in kpi.BUILDERS.items():
        write_gold(build(df, RUN), root, table)
    names = register_gold(spark, root, "gold_test")
    assert register_gold(spark, f"file://{root}/", "gold_test") == names

    top = reports.top_zones(spark, 2024, 1, table="gold_test.daily_revenue_by_zone")
    assert [tuple(r) for r in top.collect()] == [
        ("Market", "South", 100, 1400.0),
        (None, None, 50, 700.0),
        ("Harbour", "North", 50, 700.0),
    ]
    # Period keys are numbers and still compare with the text of a number.
    as_text = spark.sql(
        "SELECT sum(total_trips) FROM gold_test.daily_revenue_by_zone "
        "WHERE _year = '2024' AND _month = '1'"
    )
    assert as_text.first()[0] == 200
    hours = reports.peak_weekday_hours(spark, 2024, table="gold_test.hourly_demand")
    # Of the three days only the one in January is a weekday; its rows fall on 8 hours.
    assert [(r["pickup_hour"], r["total_trips"]) for r in hours.collect()] == [
        (hour, 25) for hour in range(0, 24, 3)
    ]

    # Another period appears after a new registration only.
    later = read_gold(spark, root, "hourly_demand").withColumn("_year", F.lit(2025))
    later = spark.createDataFrame(later.collect(), later.schema)
    write_gold(later, root, "hourly_demand")
    register_gold(spark, root, "gold_test")
    years = spark.sql("SELECT DISTINCT _year FROM gold_test.hourly_demand").collect()
    assert {r[0] for r in years} == {2024, 2025}

    with pytest.raises(ValueError, match="registered over"):
        register_gold(spark, str(tmp_path / "elsewhere"), "gold_test")


def test_previews_are_ordered_and_bounded(spark):
    df = silver(spark, many(spark, 50, payment_type="id % 12", total_amount="id"))
    shown = reports.preview_payments(kpi.payment_type_summary(df, RUN)).collect()
    assert len(shown) == 10
    revenue = [r["total_revenue"] for r in shown]
    assert revenue == sorted(revenue, reverse=True)
    assert reports.preview_silver(df).columns == list(reports.SILVER_PREVIEW)
    assert reports.preview_silver(df).count() == 5


def test_nan_and_infinity_carry_through_the_roll_up(spark):
    rows = [("a", math.nan, 1), ("a", 2.0, 1), ("b", math.inf, 1), ("c", 1e27, 1), ("c", 1.5, 1)]
    daily = spark.createDataFrame(rows, "pickup_zone string, total_revenue double, total_trips long")
    daily = daily.withColumn("pickup_borough", F.lit("x"))
    found = {r["pickup_zone"]: r["revenue"] for r in reports.revenue_by_zone(daily).collect()}
    assert math.isnan(found["a"]) and found["b"] == math.inf and found["c"] == 1e27


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}", "relative"])
def test_registration_takes_any_form_of_a_path(spark, tmp_path, form):
    root = tmp_path / "gold"
    for table, schema in trips.GOLD_TABLES.items():
        spark.createDataFrame([], schema).write.partitionBy(*trips.PERIOD).parquet(f"{root}/{table}")
    here = os.path.relpath(root) if form == "relative" else form.format(root)
    database = f"form_{abs(hash((str(tmp_path), form)))}"
    for _ in range(2):
        register_gold(spark, here, database)
    with pytest.raises(ValueError, match="registered over"):
        register_gold(spark, str(tmp_path / "other"), database)


def test_work_folder_of_a_session_without_a_shared_one():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master, applicationId = "local[2]", "some-application"

    class Session:
        conf, sparkContext = Conf(), Context()

    first, second = (session.work_folder(Session(), "x") for _ in range(2))
    assert first != second and os.path.dirname(first) == os.path.dirname(second)
    Context.master = "spark://host:7077"
    with pytest.raises(ValueError):
        session.work_folder(Session(), "x")

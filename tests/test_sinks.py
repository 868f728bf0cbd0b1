"""Writers that are run again."""

import os

from pyspark.sql import functions as F

from rows import many, raw
from tierline.operators.ingest import with_lineage, with_period
from tierline.operators.quality import rejected_rows
from tierline.operators.standardise import standardise
from tierline.sinks.tables import write_by_period, write_gold, write_quarantine
from tierline.sources.tables import read_bronze, read_gold, read_quarantine
from tierline.trips import GOLD_TABLES

MONTH = "make_timestamp(2024, 1 + id % 3, 10, 8, 0, 0)"


def three_months(spark, n=30, **expressions):
    df = many(
        spark,
        n,
        tpep_pickup_datetime=MONTH,
        tpep_dropoff_datetime=f"{MONTH} + interval 5 minutes",
        **expressions,
    )
    return with_period(with_lineage(df, "in/", "2024-07-01"))


def per_month(df):
    counts = df.groupBy("_year", "_month").agg(
        F.count("*").alias("n"), F.sum("tip_amount").alias("tips")
    )
    return sorted(
        (str(r["_year"]), str(r["_month"]), r["n"], r["tips"]) for r in counts.collect()
    )


def test_one_period_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first = three_months(spark)
    assert write_by_period(first, path) == 30
    before = [("2024", f"0{m}", 10, 20.0) for m in (1, 2, 3)]
    assert per_month(read_bronze(spark, path)) == before

    other = three_months(spark, 12).filter("_month = '02'").withColumn("tip_amount", F.lit(1.0))
    assert write_by_period(other, path, rebalance=True) == 4
    assert per_month(read_bronze(spark, path)) == [before[0], ("2024", "02", 4, 4.0), before[2]]
    assert write_by_period(other, path) == 4
    assert per_month(read_bronze(spark, path)) == [before[0], ("2024", "02", 4, 4.0), before[2]]
    assert read_bronze(spark, path, [("2024", "03")]).count() == 10


def test_rows_without_pickup_have_their_own_period(spark, tmp_path):
    path = str(tmp_path / "t")
    df = with_period(with_lineage(raw(spark, {}, {"tpep_pickup_datetime": None}), "in/", "2024-07-01"))
    assert write_by_period(df, path) == 2
    assert read_bronze(spark, path, [(None, None)]).first()["tpep_pickup_datetime"] is None
    assert read_bronze(spark, path, [(None, None), ("2024", "01")]).count() == 2


def rejects(df):
    return rejected_rows(standardise(df))


def test_full_quarantine_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "q")
    bad = three_months(spark, trip_distance="-1")
    assert write_quarantine(rejects(bad), path) == 30
    assert read_quarantine(spark, path).count() == 30
    assert write_quarantine(rejects(three_months(spark)), path) == 0
    assert read_quarantine(spark, path).count() == 0


def test_period_quarantine_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "q")
    bad = three_months(spark, trip_distance="-1")
    write_quarantine(rejects(bad), path)
    feb = [("2024", "02")]
    assert write_quarantine(rejects(three_months(spark)), path, feb) == 0
    assert per_month(read_quarantine(spark, path)) == [
        ("2024", "01", 10, 20.0),
        ("2024", "03", 10, 20.0),
    ]
    assert write_quarantine(rejects(bad), path, feb) == 10
    assert len(per_month(read_quarantine(spark, path))) == 3
    undated = with_period(
        with_lineage(
            raw(spark, {"tpep_pickup_datetime": None, "trip_distance": -1.0}), "in/", "2024-07-01"
        )
    )
    assert write_quarantine(rejects(undated), path, [(None, None)]) == 1
    assert read_quarantine(spark, path, [(None, None)]).count() == 1
    assert read_quarantine(spark, path).count() == 31


def test_gold_write_is_few_sorted_files(spark, tmp_path):
    names = [f.name for f in GOLD_TABLES["hourly_demand"].fields]
    columns = {
        "pickup_hour": "cast(23 - id % 24 as int)",
        "total_trips": "id",
        "_year": "2024",
        "_month": "cast(1 + id % 2 as int)",
    }
    df = spark.range(480, numPartitions=8).select(
        *(
            F.expr(columns.get(f.name, "null")).cast(f.dataType).alias(f.name)
            for f in GOLD_TABLES["hourly_demand"].fields
        )
    )
    assert df.columns == names
    assert write_gold(df, str(tmp_path), "hourly_demand") == 480
    folder = tmp_path / "hourly_demand" / "_year=2024" / "_month=1"
    files = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) == 1
    hours = [r[0] for r in spark.read.parquet(str(folder / files[0])).select("pickup_hour").collect()]
    assert hours == sorted(hours)
    assert read_gold(spark, str(tmp_path), "hourly_demand", [(2024, 2)]).count() == 240

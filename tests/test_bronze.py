"""Gate, lineage and reading of raw files."""

from datetime import datetime

import pytest

from rows import many, raw
from tierline.operators.ingest import (
    GateFailed,
    enforce_gate,
    null_rates,
    with_lineage,
    with_period,
)
from tierline.sources.tables import RawInput, read_raw_trips, schema_drift
from tierline.trips import RAW_SCHEMA, RAW_SCHEMA_OLDER


def test_gate_limit_is_strict(spark):
    at_limit = many(spark, 10, PULocationID="if(id < 2, null, 1)")
    lines = enforce_gate(at_limit)
    assert {r["column_name"]: r["null_rows"] for r in lines}["PULocationID"] == 2
    above = many(spark, 10, PULocationID="if(id < 3, null, 1)")
    with pytest.raises(GateFailed, match="PULocationID: 30.00% \\(3 of 10\\)"):
        enforce_gate(above)
    assert enforce_gate(above, limit=0.5)
    assert enforce_gate(above, columns=("total_amount",))


def test_gate_refuses_no_rows(spark):
    with pytest.raises(GateFailed, match="no rows"):
        enforce_gate(raw(spark, {}).limit(0))
    assert {r["passed"] for r in null_rates(raw(spark, {}).limit(0)).collect()} == {False}


def test_lineage_and_period(spark):
    df = with_period(
        with_lineage(raw(spark, {}, {"tpep_pickup_datetime": None}), "in/", datetime(2024, 7, 1))
    )
    rows = [
        tuple(r)
        for r in df.select(
            "_ingested_at", "_source_system", "_source_path", "_year", "_month"
        ).collect()
    ]
    assert rows == [
        (datetime(2024, 7, 1), "nyc_tlc", "in/", "2024", "01"),
        (datetime(2024, 7, 1), "nyc_tlc", "in/", None, None),
    ]


def test_path_per_file(spark, tmp_path):
    raw(spark, {}).write.parquet(str(tmp_path / "in"))
    df = spark.read.schema(RAW_SCHEMA).parquet(str(tmp_path / "in"))
    path = with_lineage(df, "in/", "2024-07-01", per_file=True).first()["_source_path"]
    assert path.endswith(".parquet")


def test_schema_wins_over_files(spark, tmp_path):
    """Absent columns are NULL, extra ones dropped, names match in any case."""
    path = str(tmp_path / "in")
    (
        raw(spark, {"tip_amount": 3.0})
        .drop("airport_fee")
        .withColumnRenamed("tip_amount", "TIP_amount")
        .selectExpr("*", "1 AS surplus")
        .write.parquet(path)
    )
    raw(spark, {"airport_fee": 1.25}).write.mode("append").parquet(path)
    df = read_raw_trips(spark, [RawInput(path)])
    assert df.columns == RAW_SCHEMA.names
    rows = sorted(
        (str(r["airport_fee"]), r["tip_amount"]) for r in df.select("airport_fee", "tip_amount").collect()
    )
    assert rows == [("1.25", 2.0), ("None", 3.0)]


def test_two_generations_read_as_one(spark, tmp_path):
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    raw(spark, {"VendorID": 1}).write.parquet(new)
    raw(
        spark,
        {"VendorID": 2**40, "passenger_count": 2.0, "RatecodeID": float("nan")},
        schema=RAW_SCHEMA_OLDER,
    ).write.parquet(old)
    df = read_raw_trips(spark, [RawInput(new), RawInput(old, RAW_SCHEMA_OLDER)])
    assert df.schema == RAW_SCHEMA
    rows = df.select("VendorID", "passenger_count", "RatecodeID").collect()
    assert sorted(map(str, map(tuple, rows))) == ["(1, 1, 1)", "(None, 2, None)"]


def test_timestamps_without_zone_are_read(spark, tmp_path):
    path = str(tmp_path / "ntz")
    df = raw(spark, {})
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        df = df.withColumn(name, df[name].cast("timestamp_ntz"))
    df.write.parquet(path)
    assert read_raw_trips(spark, [RawInput(path)]).collect() == raw(spark, {}).collect()


def test_drift_report(spark, tmp_path):
    path = str(tmp_path / "in")
    (
        raw(spark, {"passenger_count": 1.0, "RatecodeID": 1.0}, schema=RAW_SCHEMA_OLDER)
        .drop("airport_fee")
        .selectExpr("*", "1 AS surplus")
        .write.parquet(path)
    )
    rows = {r["column_name"]: r["status"] for r in schema_drift(spark, path).collect()}
    assert rows["airport_fee"] == "missing" and rows["surplus"] == "extra"
    assert rows["VendorID"] == "retyped" and rows["passenger_count"] == "retyped"
    assert rows["tpep_pickup_datetime"] == "ok" and rows["total_amount"] == "ok"

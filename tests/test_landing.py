"""Landing in steps: what stops a run, what a repeat leaves, what a killed run leaves."""

import os
from dataclasses import replace

import pytest

from checks import queries
from rows import many, raw
from tierline.operators.ingest import LossyCast
from tierline.plans import jobs
from tierline.plans.config import PipelineConfig
from tierline.sinks import landing
from tierline.sources import census as census_of_files
from tierline.sinks.files import Folders
from tierline.sources.census import (
    SchemaDisagreement,
    file_columns,
    schema_census,
    type_name,
    unreadable,
)
from tierline.sources.tables import RawInput, read_bronze, read_raw_trips
from tierline.trips import RAW_SCHEMA, RAW_SCHEMA_OLDER, table_schema

RUN_TS = "2024-07-01 00:00:00"
FEBRUARY = (("2024", "02"),)


def trips_of(spark, n, months, **columns):
    """``n`` trips, dealt to months by SQL over ``id``."""
    return many(spark, n, tpep_pickup_datetime=f"make_timestamp(2024, {months}, 3, 1, 1, 0)", **columns)


@pytest.fixture
def cfg(spark, tmp_path):
    trips_of(spark, 90, "1 + id % 3").write.parquet(str(tmp_path / "raw"))
    return PipelineConfig(
        raw=(RawInput(str(tmp_path / "raw")),),
        zones="",
        bronze=str(tmp_path / "lake" / "bronze"),
        silver="",
        quarantine="",
        gold="",
        run_ts=RUN_TS,
    )


def new_input(spark, cfg, df):
    df.write.mode("overwrite").parquet(cfg.raw[0].path)


def by_month(spark, path):
    rows = read_bronze(spark, path).groupBy("_month").count().collect()
    return {r["_month"]: r["count"] for r in rows}


def nothing_beside(cfg):
    beside = f"{cfg.bronze}.landing"
    return not os.path.exists(beside) or not os.listdir(beside)


def test_a_named_month_without_rows_stops_the_run(spark, cfg, tmp_path):
    jobs.run_bronze(spark, cfg)
    new_input(spark, cfg, trips_of(spark, 30, "1"))
    month = replace(cfg, periods=FEBRUARY, strays=str(tmp_path / "strays"))
    with pytest.raises(jobs.EmptyPeriods, match="2024-02"):
        jobs.run_bronze(spark, month)
    assert by_month(spark, cfg.bronze) == {"01": 30, "02": 30, "03": 30}
    assert not os.path.exists(month.strays) and nothing_beside(cfg)
    counts = jobs.run_bronze(spark, replace(month, allow_empty=True))
    assert counts == {"raw": 30, "strays": 30, "bronze": 0}
    assert by_month(spark, cfg.bronze) == {"01": 30, "03": 30}


def test_a_repeat_leaves_the_same_strays(spark, cfg, tmp_path):
    jobs.run_bronze(spark, cfg)
    month = replace(cfg, periods=FEBRUARY, strays=str(tmp_path / "strays"))
    for ts in (RUN_TS, "2024-08-01 00:00:00"):
        counts = jobs.run_bronze(spark, replace(month, run_ts=ts))
        assert counts == {"raw": 90, "strays": 60, "bronze": 30}
        assert spark.read.parquet(month.strays).count() == 60
    other = replace(month, periods=(("2024", "03"),))
    jobs.run_bronze(spark, other)
    assert {r["run"]: r["count"] for r in spark.read.parquet(month.strays).groupBy("run").count().collect()} == {
        month.run_key: 60, other.run_key: 60
    }
    new_input(spark, cfg, trips_of(spark, 12, "2"))
    assert jobs.run_bronze(spark, month) == {"raw": 12, "strays": 0, "bronze": 12}
    assert {r["run"] for r in spark.read.parquet(month.strays).select("run").collect()} == {other.run_key}
    assert nothing_beside(cfg)


def test_strays_are_the_staged_files(spark, cfg, tmp_path, monkeypatch):
    """They are moved, not read and written a second time; elsewhere they are written."""
    rows = spark.createDataFrame([(k, "2024", f"{k % 3:02}") for k in range(9)], "x int, _year string, _month string")
    table, strays = str(tmp_path / "t"), str(tmp_path / "other")
    staged = landing.stage(rows, table, "one")
    kept = [("2024", "01")]
    written = {p.name for p in (tmp_path / "t.landing").rglob("_month=0[02]/*.parquet")}
    assert landing.write_strays(staged, rows, strays, kept) == 6
    assert {p.name for p in (tmp_path / "other").rglob("*.parquet")} == written
    assert landing.move_in(staged, kept) == 3
    staged = landing.stage(rows, table, "two")
    monkeypatch.setattr(Folders, "holds", lambda *_: False)
    assert landing.write_strays(staged, rows, strays, kept) == 6
    found = spark.read.schema("x int, run string").parquet(strays).groupBy("run").count().collect()
    assert {r["run"]: r["count"] for r in found} == {"one": 6, "two": 6}


def test_strays_keep_every_column_and_rows_without_a_moment(spark, cfg, tmp_path):
    new_input(spark, cfg, trips_of(spark, 40, "if(id % 4 = 0, null, 2)"))
    month = replace(cfg, periods=FEBRUARY, strays=str(tmp_path / "strays"), null_rate_limit=0.5)
    assert jobs.run_bronze(spark, month) == {"raw": 40, "strays": 10, "bronze": 30}
    strays = spark.read.parquet(month.strays)
    assert set(read_bronze(spark, cfg.bronze).columns) <= set(strays.columns)
    assert strays.filter("_year IS NULL AND _month IS NULL").count() == 10
    both = replace(month, periods=(*FEBRUARY, (None, None)))
    assert jobs.run_bronze(spark, both)["bronze"] == 40
    assert by_month(spark, cfg.bronze) == {"02": 30, None: 10}


def test_a_run_without_periods_does_not_shrink_a_month(spark, cfg):
    jobs.run_bronze(spark, cfg)
    new_input(spark, cfg, trips_of(spark, 50, "if(id = 0, 1, 4)"))
    with pytest.raises(jobs.ShrinkingPeriods, match="2024-01"):
        jobs.run_bronze(spark, cfg)
    assert by_month(spark, cfg.bronze) == {"01": 30, "02": 30, "03": 30} and nothing_beside(cfg)
    assert jobs.run_bronze(spark, replace(cfg, allow_shrinking=True))["bronze"] == 50
    assert by_month(spark, cfg.bronze) == {"01": 1, "02": 30, "03": 30, "04": 49}


def older_input(spark, tmp_path):
    path = str(tmp_path / "older")
    values = [{"VendorID": 2**40}, {"passenger_count": 1.5}, {"RatecodeID": float("nan")}, {}]
    filled = [{"passenger_count": 1.0, "RatecodeID": 1.0} | v for v in values]
    raw(spark, *filled, schema=RAW_SCHEMA_OLDER).write.parquet(path)
    return RawInput(path, RAW_SCHEMA_OLDER)


def test_lost_values_are_counted_and_stop_the_run(spark, cfg, tmp_path):
    two = replace(cfg, raw=(*cfg.raw, older_input(spark, tmp_path)))
    with pytest.raises(LossyCast, match="VendorID: 1 made NULL, 0 changed, of 94"):
        jobs.run_bronze(spark, two)
    assert not os.path.exists(cfg.bronze) and nothing_beside(cfg)
    for rebalance in (False, True):
        counts = jobs.run_bronze(spark, replace(two, cast_loss_limit=0.02, rebalance_bronze=rebalance))
        lost = {k: v for k, v in counts.items() if " " in k}
        assert {k: v for k, v in lost.items() if v} == {"nulled VendorID": 1, "changed passenger_count": 1}
        assert len(lost) == 10 and counts["bronze"] == 94
    assert read_bronze(spark, cfg.bronze).columns[-2:] == ["_year", "_month"]
    assert not [c for c in spark.read.parquet(cfg.bronze).columns if c.startswith("_lost")]


def test_many_columns_are_audited(spark):
    wide = table_schema(**{f"c{i}": "int" for i in range(70)})
    there = table_schema(**{f"c{i}": "double" for i in range(70)})
    from tierline.sources.tables import audit_columns, audited_fields, conform, loss_counts

    rows = spark.createDataFrame([[float(i) for i in range(70)], [i + 0.5 for i in range(70)], [1e300] * 70], there)
    fields = audited_fields([RawInput("x", there)], wide)
    assert len(audit_columns(wide)) == 3 and len(fields) == 70
    found = conform(rows, wide, audit=True).agg(*loss_counts(fields, wide)).first().asDict()
    assert set(found.values()) == {1} and len(found) == 140


@pytest.mark.parametrize("few", [64, 1])
def test_files_that_disagree_stop_the_run(spark, cfg, monkeypatch, few):
    monkeypatch.setattr(census_of_files, "FEW", few)
    jobs.run_bronze(spark, cfg)
    older = raw(spark, {"passenger_count": 1.0, "RatecodeID": 1.0}, schema=RAW_SCHEMA_OLDER)
    older.coalesce(1).write.mode("append").parquet(cfg.raw[0].path)
    with pytest.raises(SchemaDisagreement, match="VendorID is bigint and not int in 1 file"):
        jobs.run_bronze(spark, cfg)
    assert by_month(spark, cfg.bronze) == {"01": 30, "02": 30, "03": 30}
    census = schema_census(spark, cfg.raw[0].path)
    lines = {(r["column_name"], r["type"]): (r["n_files"], r["n_rows"]) for r in census.collect()}
    assert lines["VendorID", "int"][1] == 90 and lines["VendorID", "bigint"] == (1, 1)
    assert lines["total_amount", "double"][1] == 91
    wrong = {r["column_name"] for r in unreadable(census, RAW_SCHEMA).collect()}
    assert wrong == {"VendorID", "PULocationID", "DOLocationID", "passenger_count", "RatecodeID"}


def test_census_of_names_types_and_folders(spark, tmp_path):
    path = str(tmp_path / "in put%20")
    df = raw(spark, {}).selectExpr("*", "CAST(tip_amount AS decimal(9,2)) AS more")
    df.withColumnRenamed("tip_amount", "TIP_amount").write.parquet(f"{path}/part=1")
    raw(spark, {}, {}).drop("airport_fee").write.parquet(f"{path}/part=2")
    lines = {r["column_name"]: r for r in schema_census(spark, path).collect()}
    assert lines["TIP_amount"]["n_files"] >= 2 and lines["TIP_amount"]["n_rows"] == 3
    assert lines["airport_fee"]["n_rows"] == 1 and lines["more"]["type"] == "decimal(9,2)"
    assert "part=" in lines["more"]["a_file"]
    assert file_columns(spark, path).filter("column_name = 'VendorID'").count() >= 2
    assert unreadable(schema_census(spark, path), RAW_SCHEMA).isEmpty()


@pytest.mark.parametrize("reader", ["here", "tasks", "whole files"])
def test_all_ways_to_the_footers_agree(spark, cfg, monkeypatch, reader):
    want = sorted(map(tuple, file_columns(spark, cfg.raw[0].path).collect()))
    assert len(want) == 8 * len(RAW_SCHEMA.fields)
    if reader != "here":
        monkeypatch.setattr(census_of_files, "FEW", 2)
    if reader == "whole files":
        monkeypatch.setattr(census_of_files, "_SCHEMES", {})
    assert sorted(map(tuple, file_columns(spark, cfg.raw[0].path).collect())) == want


def test_old_and_zoneless_timestamps_are_told_apart(spark, tmp_path):
    import pyarrow as pa

    one = str(tmp_path / "t")
    df = spark.sql("SELECT timestamp'2024-01-01' a, timestamp_ntz'2024-01-01' b, 1Y c, 1S d")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    df.write.parquet(one)
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    df.write.mode("append").parquet(one)
    lines = {(r["column_name"], r["type"]) for r in schema_census(spark, one).collect()}
    assert lines == {("a", "timestamp"), ("b", "timestamp_ntz"), ("c", "tinyint"), ("d", "smallint")}
    assert type_name(pa.list_(pa.int32())).startswith("list")


@pytest.mark.parametrize("there, wanted", [("int", "bigint"), ("int", "double"), ("float", "double"),
                                           ("smallint", "int"), ("tinyint", "int")])
def test_narrower_files_are_read_without_loss(spark, tmp_path, there, wanted):
    """What the census lets pass is what Spark reads."""
    name = {"int": "VendorID", "bigint": "payment_type", "double": "tip_amount"}[wanted]
    path = str(tmp_path / "in")
    spark.range(3).selectExpr(f"CAST(id AS {there}) AS {name}").write.parquet(path)
    assert unreadable(schema_census(spark, path), RAW_SCHEMA).isEmpty()
    assert sorted(r[name] for r in read_raw_trips(spark, [RawInput(path)]).collect()) == [0, 1, 2]


def test_a_killed_run_is_put_back_by_its_repeat(spark, cfg, monkeypatch):
    """The run ends between moving the old folder aside and moving the new one in."""
    jobs.run_bronze(spark, cfg)
    new_input(spark, cfg, trips_of(spark, 45, "2"))
    month = replace(cfg, periods=FEBRUARY)
    moves = []
    real = Folders.move

    def second_move_fails(self, name, to):
        moves.append(name)
        if len(moves) == 2:
            raise KeyboardInterrupt
        real(self, name, to)

    monkeypatch.setattr(Folders, "move", second_move_fails)
    monkeypatch.setattr(landing, "_swap_back", lambda *_: None)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_bronze(spark, month)
    monkeypatch.setattr(Folders, "move", real)
    assert by_month(spark, cfg.bronze) == {"01": 30, "03": 30}
    landing.put_back(spark, cfg.bronze, month.run_key)
    assert by_month(spark, cfg.bronze) == {"01": 30, "02": 30, "03": 30}
    moves.clear()
    monkeypatch.setattr(Folders, "move", second_move_fails)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_bronze(spark, month)
    monkeypatch.setattr(Folders, "move", real)
    assert jobs.run_bronze(spark, month)["bronze"] == 45
    assert by_month(spark, cfg.bronze) == {"01": 30, "02": 45, "03": 30} and nothing_beside(cfg)


@pytest.mark.parametrize("table", ["/bronze", "bronze", "lake/bronze", "s3a://bucket/lake/bronze/"])
def test_tables_anywhere_have_a_folder_beside(monkeypatch, table):
    monkeypatch.setattr(landing, "Folders", lambda spark, path: path)
    parent, name, beside = landing._around(None, table, "r")
    assert (name, beside) == ("bronze", "bronze.landing/r")
    assert parent == {"/bronze": "/", "bronze": "."}.get(table, table.rstrip("/")[: -len("/bronze")])
    assert landing._beside(table, "r") == f"{table.rstrip('/')}.landing/r"


def test_a_move_onto_something_is_refused(spark, tmp_path):
    for name in ("a", "b"):
        os.makedirs(tmp_path / name)
    with pytest.raises(OSError):
        Folders(spark, str(tmp_path)).move("a", "b")


def test_files_written_by_share_are_as_many_as_asked_for(spark, tmp_path):
    rows, folder = spark.range(700, numPartitions=7), f"{tmp_path}/mixed/file=1"
    writes = queries._write_files(spark, rows, 3, lambda part: part.filter("id < 600"), folder)
    jobs._together(spark, writes)
    written = spark.read.parquet(f"{tmp_path}/mixed")
    assert sorted(r["id"] for r in written.collect()) == list(range(600))
    census = schema_census(spark, f"{tmp_path}/mixed").collect()
    assert [(r["type"], r["n_files"], r["n_rows"]) for r in census] == [("bigint", 3, 600)]
    assert max(r["count"] for r in written.groupBy("file").count().collect()) < 250

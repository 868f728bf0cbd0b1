"""The physical plans are the intended ones."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from checks import queries as registered_queries
from rows import many, zones
from tierline.operators import dedup, enrich, ingest, kpi, quality, reports, standardise
from tierline.plans import jobs
from tierline.plans.config import PipelineConfig
from tierline.session import work_folder
from tierline.sinks.landing import rows_by_period
from tierline.sinks.tables import write_by_period
from tierline.sources.lookup import LookupFacts, checked_lookup, read_zone_lookup
from tierline.sources.tables import RawInput, read_bronze, read_raw_trips, read_silver

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def run(spark):
    return registered_queries.pipeline_run(spark, SF_DIR)[0]


@pytest.fixture(scope="module")
def silver_plan(spark, run):
    std = standardise.standardise(read_bronze(spark, run.bronze))
    return plan(jobs.silver_frame(std, zones(spark), run))


def test_silver_broadcasts_both_roles_and_shuffles_once(silver_plan):
    assert silver_plan.count("BroadcastHashJoin") == 2
    assert silver_plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in silver_plan


def test_dedup_cuts_groups_on_both_sides_of_the_shuffle(silver_plan):
    limits = [m.start() for m in re.finditer("WindowGroupLimit", silver_plan)]
    exchange = silver_plan.index("Exchange hashpartitioning")
    assert len(limits) == 2 and limits[0] < exchange < limits[1]
    assert "Partial" in silver_plan[limits[1] : limits[1] + 1000]


def test_silver_does_not_carry_what_it_derives_again(silver_plan):
    """Old period keys and reasons are gone before the shuffle."""
    below = silver_plan[silver_plan.index("Exchange hashpartitioning") :]
    assert "concat_ws" not in silver_plan
    assert "_year" not in below[: below.index("FileScan")]


def test_large_lookup_is_joined_by_shuffle_without_copies(spark):
    df = standardise.standardise(many(spark, 100, PULocationID="id % 5", DOLocationID="id % 7"))
    large = LookupFacts(rows=10**9, text_bytes=0, repeated_keys=0)
    text = plan(enrich.enrich_with_zones(df, zones(spark), large))
    assert text.count("SortMergeJoin") == 2
    assert re.search(r"hashpartitioning\(pickup_location_id#\d+, ", text)
    assert not re.search("Broadcast|Cartesian|NestedLoop|Generate", text)


def test_large_lookup_with_one_busy_location(spark):
    df = standardise.standardise(
        many(spark, 4_000, PULocationID="if(id % 2 = 0, 1, id % 300)", DOLocationID="id % 7")
    )
    large = LookupFacts(rows=10**9, text_bytes=0, repeated_keys=0)
    small = LookupFacts(rows=1, text_bytes=0, repeated_keys=0)
    found, expected = (enrich.enrich_with_zones(df, zones(spark), f) for f in (large, small))
    assert found.count() == 4_000
    assert found.exceptAll(expected.select(found.columns)).isEmpty()


@pytest.mark.parametrize("table", list(kpi.BUILDERS))
def test_gold_is_one_hash_aggregate_over_its_columns(spark, run, table):
    text = plan(kpi.BUILDERS[table](read_silver(spark, run.silver), run.run_ts))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1
    assert "SortAggregate" not in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    unused = {
        "daily_revenue_by_zone": ("tip_amount", "dropoff_zone", "_source_path"),
        "hourly_demand": ("fare_amount", "pickup_zone"),
        "payment_type_summary": ("trip_distance", "pickup_zone"),
    }[table]
    assert not [c for c in unused if c in schema]


def test_period_reads_prune_partitions(spark, run):
    text = plan(read_silver(spark, run.silver, [("2022", "03")]))
    assert "PartitionFilters: [(_year" in text or "PartitionFilters: [isnotnull(_year" in text


def test_reports_prune_partitions_and_keep_a_top_n(spark, run):
    top = plan(reports.top_zones(spark, 2022, 3, table=f"{run.database}.daily_revenue_by_zone"))
    hours = plan(reports.peak_weekday_hours(spark, 2022, table=f"{run.database}.hourly_demand"))
    for text in (top, hours):
        assert "TakeOrderedAndProject" in text
        assert re.search(r"PartitionFilters: \[[^\]]*_year", text)


def test_gate_reads_its_columns_only(spark, run):
    text = plan(ingest.null_rates(read_raw_trips(spark, run.raw)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert len(schema.split(",")) == len(ingest.trips.CRITICAL_COLUMNS)


def test_filters_reach_the_raw_scan(spark, run):
    df = read_raw_trips(spark, run.raw).filter("PULocationID = 5 AND total_amount > 10")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan(df)).group(1)
    assert "EqualTo(PULocationID,5)" in pushed and "GreaterThan(total_amount,10.0)" in pushed


def test_gate_can_be_answered_from_footers(spark, run):
    """With aggregate pushdown switched on, no column data is read at all."""
    settings = {
        "spark.sql.sources.useV1SourceList": "",
        "spark.sql.parquet.aggregatePushdown": "true",
    }
    kept = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rates = ingest.null_rates(read_raw_trips(spark, run.raw))
        assert re.search(r"PushedAggregation: \[COUNT\(", plan(rates))
        pushed = rates.collect()
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert pushed == ingest.null_rates(read_raw_trips(spark, run.raw)).collect()


def test_no_python_in_any_plan(spark, run):
    for name in ("silver", "quarantine", "hourly_demand", "daily_revenue_by_zone", "typed_scan"):
        text = plan(registered_queries.registered()[name](spark, SF_DIR))
        assert not re.search("Python|Pandas|Arrow", text), name
        assert not re.search("Cartesian|NestedLoop", text), name


def test_valid_rows_survive_repartitioning(spark):
    df = standardise.standardise(many(spark, 300, total_amount="id % 30", VendorID="id % 7"))
    results = [
        sorted(map(str, dedup.deduplicate(quality.valid_rows(df.repartition(n))).collect()))
        for n in (1, 16)
    ]
    assert results[0] == results[1] and len(results[0]) == 30


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a.startswith(shared) and a != b


def test_period_list_and_layout():
    base = PipelineConfig(
        raw=(RawInput("r"),), zones="z", bronze="b", silver="s", quarantine="q", gold="g"
    )
    assert base.gold_periods is None
    one = replace(base, periods=(("2024", "02"),))
    assert one.gold_periods == ((2024, 2),)
    two = replace(base, periods=(("2024", "02"), (None, None)))
    assert two.gold_periods == ((2024, 2), (None, None))
    assert one.run_key != two.run_key and one.run_key == replace(one, run_ts="2024-01-01").run_key


def test_months_are_batched_by_their_rows():
    rows = {("2024", f"{m:02d}"): n for m, n in enumerate((5, 5, 30, 1, 2, 3, 9), 1)} | {(None, None): 2}
    assert jobs.month_batches(rows, 10) == [
        (("2024", "01"), ("2024", "02")),
        (("2024", "03"),),
        (("2024", "04"), ("2024", "05"), ("2024", "06")),
        (("2024", "07"),),
        ((None, None),),
    ]
    assert jobs.month_batches({}, 10) == []


@pytest.mark.parametrize("most", [1, 700, 10**9])
def test_a_full_silver_run_shuffles_its_trips_once(spark, run, most):
    """Of each batch: one exchange over trips, whatever the size of the months."""
    lookup = read_zone_lookup(spark, run.zones)
    facts = checked_lookup(lookup)
    rows = rows_by_period(read_bronze(spark, run.bronze))
    batches = jobs.month_batches(rows, most)
    assert (most > 1) == any(len(b) > 1 for b in batches)
    for batch in (batches[0], max(batches, key=len), batches[-1]):
        text = plan(jobs.silver_batch(spark, run, lookup, facts, batch))
        exchanges = re.findall(r"(?<!Broadcast)Exchange (\w+)\(([^)]*)\)", text)
        dealt = [what for how, what in exchanges if how == "hashpartitioning"]
        assert len(exchanges) == len(dealt) == 1 and text.count("BroadcastExchange") == 2
        # A large month is dealt by trip, small ones by month.
        assert ("pickup_datetime" in dealt[0]) == (len(batch) == 1)
        assert ("_month" in dealt[0]) == (len(batch) > 1)


def test_rebalance_splits_a_period_with_most_rows(spark, tmp_path):
    """Two thirds of the rows are one month; it is written by several tasks."""
    month = "if(id % 3 < 2, 1, 2 + id % 10)"
    df = ingest.with_period(
        ingest.with_lineage(
            many(
                spark,
                120_000,
                tpep_pickup_datetime=f"make_timestamp(2024, {month}, 1, id % 24, id % 60, 0)",
                total_amount="xxhash64(id) % 100000 / 100",
            ),
            "in/",
            "2024-07-01",
        )
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(size)
    try:
        spark.conf.set(size, str(256 * 1024))
        write_by_period(df, str(tmp_path), rebalance=True)
    finally:
        spark.conf.set(size, kept)
    hot = list((tmp_path / "_year=2024" / "_month=01").glob("*.parquet"))
    rare = list((tmp_path / "_year=2024" / "_month=05").glob("*.parquet"))
    assert len(hot) > 2 and len(rare) <= 2
    assert read_bronze(spark, str(tmp_path)).count() == 120_000


def test_rebalanced_write_makes_few_files(spark, tmp_path):
    df = ingest.with_period(
        ingest.with_lineage(
            many(spark, 1000, tpep_pickup_datetime="make_timestamp(2024, 1 + id % 5, 1, 0, 0, 0)"),
            "in/",
            "2024-07-01",
        )
    )
    write_by_period(df, str(tmp_path / "plain"))
    write_by_period(df, str(tmp_path / "joined"), rebalance=True)
    files = {n: len(list((tmp_path / n).rglob("*.parquet"))) for n in ("plain", "joined")}
    assert files == {"plain": 40, "joined": 5}


def test_small_months_are_sorted_by_the_trip_before_the_month(spark):
    pickup = "make_timestamp(2024, 1 + id % 3, 1 + id % 4, id % 2, 0, 0)"
    rows = many(spark, 300, VendorID="id % 5", tpep_pickup_datetime=pickup, extra="id % 7")
    std = standardise.standardise(ingest.with_period(rows))
    dealt = dedup.deduplicate(std, dealt_by=("_year", "_month"))
    assert "Sort [pickup_datetime" in plan(dealt) and "Sort [_year" not in plan(dealt)
    assert plan(dealt).count("Exchange") == 1
    kept = sorted(map(str, dedup.deduplicate(std).collect()))
    assert len(kept) == 12 and sorted(map(str, dealt.collect())) == kept


def test_raw_trips_by_time_shuffle_line_items(spark, tmp_path):
    items = spark.range(400, numPartitions=4).selectExpr(
        "id AS l_orderkey",
        "id * 7 AS l_partkey",
        "id % 91 AS l_suppkey",
        "int(id % 7) AS l_linenumber",
        *(f"double(id) AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        "if(id % 2 = 0, 'R', 'N') AS l_returnflag",
        "'a text that no trip has' AS l_comment",
        "timestamp '1996-01-01 00:00:00' + make_dt_interval(int(id * 7919 % 900)) AS l_shipdate",
    )
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    rows, dealt = (f(spark, str(tmp_path)) for f in (fixtures.trips, fixtures.trips_by_time))
    below = plan(dealt)[plan(dealt).index("Exchange rangepartitioning") :]
    assert "tpep_" not in below and "l_comment" not in below
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    moment = F.col("tpep_pickup_datetime")
    spans = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.min(moment), F.max(moment))
    found = [r[1:] for r in spans.orderBy("part").collect()]
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))

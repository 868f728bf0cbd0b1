"""Edge cases of standardising, tagging, deduplication and enrichment."""

import math
from datetime import datetime, timedelta

import pytest

from rows import CLEAN, many, raw, zones
from tierline.operators.dedup import deduplicate
from tierline.operators.enrich import enrich_with_zones
from tierline.operators.ingest import with_lineage, with_period
from tierline.operators.quality import rejected_rows, split_summary, tag, valid_rows
from tierline.operators.standardise import standardise, with_silver_metadata
from tierline.sources.lookup import (
    LookupFacts,
    RepeatedLookupKey,
    checked_lookup,
    inspect_lookup,
    read_zone_lookup,
)
from tierline.sources.tables import conform
from tierline.trips import (
    QUARANTINE_SCHEMA,
    RAW_SCHEMA,
    RAW_SCHEMA_OLDER,
    SILVER_SCHEMA,
    quality_rules,
)

PICKUP = CLEAN["tpep_pickup_datetime"]


def tagged(spark, *changes, rules=None):
    """(dq_issues, is_valid) per row, in input order."""
    df = raw(spark, *({**c, "RatecodeID": i} for i, c in enumerate(changes)))
    rows = tag(standardise(df), rules).orderBy("rate_code_id").collect()
    return [(r["dq_issues"], r["is_valid"]) for r in rows]


def in_year(year):
    start = PICKUP.replace(year=year)
    return {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + timedelta(minutes=5),
    }


def test_missing_values_pass_unless_a_rule_asks(spark):
    changes = (
        {"tpep_pickup_datetime": None},
        {"tpep_dropoff_datetime": None},
        {"trip_distance": None},
        {"total_amount": None},
    )
    assert tagged(spark, *changes) == [("", True)] * 4
    strict = quality_rules(required=("total_amount",))
    assert tagged(spark, changes[3], rules=strict) == [("null_total_amount", False)]


def test_year_limits_are_inclusive(spark):
    late = "pickup_year_out_of_range(2019-2025)"
    assert tagged(spark, *map(in_year, (2018, 2019, 2025, 2026))) == [
        (late, False),
        ("", True),
        ("", True),
        (late, False),
    ]
    rules = quality_rules(2000, 2018)
    assert tagged(spark, in_year(2019), rules=rules) == [
        ("pickup_year_out_of_range(2000-2018)", False)
    ]


def test_zero_is_valid_except_for_the_duration(spark):
    assert tagged(
        spark,
        {"trip_distance": 0.0, "total_amount": 0.0},
        {"tpep_dropoff_datetime": PICKUP},
        {"tpep_dropoff_datetime": PICKUP - timedelta(seconds=1)},
    ) == [("", True), ("non_positive_duration", False), ("non_positive_duration", False)]


def test_reasons_keep_rule_order(spark):
    every = {
        "tpep_pickup_datetime": PICKUP.replace(year=2030),
        "tpep_dropoff_datetime": PICKUP,
        "trip_distance": -1.0,
        "total_amount": -1.0,
        "PULocationID": None,
        "DOLocationID": None,
    }
    assert tagged(spark, {"trip_distance": -1.0, "DOLocationID": None}, every) == [
        ("negative_trip_distance, null_dropoff_location", False),
        (
            "pickup_year_out_of_range(2019-2025), negative_trip_distance, "
            "negative_total_amount, null_pickup_location, null_dropoff_location, "
            "non_positive_duration",
            False,
        ),
    ]


def test_flag_count_and_duration(spark):
    df = raw(
        spark,
        {"store_and_fwd_flag": "Y", "passenger_count": 2},
        {"store_and_fwd_flag": "N", "passenger_count": None},
        {"store_and_fwd_flag": "y", "passenger_count": 10**12},
        {"store_and_fwd_flag": None, "passenger_count": 0},
    )
    rows = standardise(df).select("store_and_fwd_flag", "passenger_count").collect()
    assert [tuple(r) for r in rows] == [(True, 2), (False, 0), (False, 0), (False, 0)]

    times = raw(
        spark,
        {
            "tpep_pickup_datetime": PICKUP.replace(microsecond=900000),
            "tpep_dropoff_datetime": PICKUP + timedelta(seconds=100, microseconds=100000),
        },
        {"tpep_dropoff_datetime": None},
    )
    minutes = [r[0] for r in standardise(times).select("trip_duration_minutes").collect()]
    assert minutes == [1.67, None]


def test_older_types_truncate_and_default(spark):
    older = raw(
        spark,
        *({"passenger_count": v, "RatecodeID": 1.0} for v in (1.9, math.nan, 1e12, None)),
        schema=RAW_SCHEMA_OLDER,
    )
    rows = standardise(conform(older, RAW_SCHEMA)).select("passenger_count").collect()
    assert [r[0] for r in rows] == [1, 0, 0, 0]


def vendors(df):
    return [r["vendor_id"] for r in deduplicate(df).collect()]


def test_dedup_prefers_the_lowest_vendor_and_null_first(spark):
    assert vendors(standardise(raw(spark, {"VendorID": 2}, {"VendorID": 1}))) == [1]
    assert vendors(standardise(raw(spark, {"VendorID": 1}, {"VendorID": None}))) == [None]


def test_null_and_signed_zero_keys_are_one_trip(spark):
    nulls = raw(spark, *[{"tpep_pickup_datetime": None, "total_amount": None}] * 2)
    assert deduplicate(standardise(nulls)).count() == 1
    zeros = raw(spark, {"total_amount": 0.0, "VendorID": 2}, {"total_amount": -0.0})
    assert vendors(standardise(zeros)) == [1]


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_of_signed_zeros_the_same_one_is_kept(spark, parts):
    zeros = raw(spark, *[{"total_amount": x} for x in (0.0, -0.0, -0.0, 0.0)])
    kept = deduplicate(standardise(zeros).repartition(parts)).collect()
    assert [str(r["total_amount"]) for r in kept] == ["-0.0"]


@pytest.mark.parametrize("parts", [1, 5, 16])
def test_dedup_does_not_depend_on_partitioning(spark, parts):
    copies = [{"tip_amount": float(9 - i), "payment_type": i % 3} for i in range(9)]
    df = standardise(raw(spark, *copies)).repartition(parts)
    kept = deduplicate(df).collect()
    assert [(r["payment_type"], r["tip_amount"]) for r in kept] == [(0, 3.0)]
    assert deduplicate(deduplicate(df)).collect() == kept


def test_a_trip_with_a_third_of_all_rows(spark):
    hot = many(spark, 30_000)
    cold = many(spark, 60_000, total_amount="100 + id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        kept = deduplicate(standardise(hot.unionByName(cold)))
        assert len(kept.collect()) == 60_001
        # The hot trip crosses the shuffle once per map task, not 30,000 times.
        assert 60_000 < shuffled_rows(kept) <= 60_000 + 16
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def shuffled_rows(df):
    node = df._jdf.queryExecution().executedPlan()
    while node.nodeName() != "Exchange":
        node = node.children().head()
    return node.metrics().apply("shuffleRecordsWritten").value()


def test_rejected_rows_are_neither_deduplicated_nor_lost(spark):
    df = standardise(raw(spark, *[{"trip_distance": -1.0}] * 2, {}))
    assert rejected_rows(df).count() == 2
    assert valid_rows(df).columns == df.columns
    summary = split_summary(tag(df)).first()
    assert tuple(summary) == (3, 1, 2, 1 / 3, 2 / 3)
    empty = split_summary(tag(df.limit(0))).first()
    assert tuple(empty) == (0, 0, 0, None, None)


LARGE = LookupFacts(rows=10**9, text_bytes=0, repeated_keys=0)


@pytest.mark.parametrize("facts", [None, LARGE])
def test_enrichment_keeps_every_trip(spark, facts):
    df = standardise(
        raw(spark, {}, {"PULocationID": 99}, {"PULocationID": None}, {"DOLocationID": 1})
    )
    rows = enrich_with_zones(df, zones(spark), facts).collect()
    got = sorted(
        (str(r["pickup_location_id"]), str(r["pickup_zone"]), r["dropoff_borough"]) for r in rows
    )
    assert got == [
        ("1", "Harbour", "North"),
        ("1", "Harbour", "South"),
        ("99", "None", "South"),
        ("None", "None", "South"),
    ]


def test_repeated_lookup_key_is_refused(spark):
    twice = zones(spark, [(1, "a", "b", "c"), (1, "d", "e", "f"), (None, "", "", ""), (None, "", "", "")])
    assert inspect_lookup(twice).repeated_keys == 1
    with pytest.raises(RepeatedLookupKey):
        checked_lookup(twice)
    with pytest.raises(RepeatedLookupKey):
        enrich_with_zones(standardise(raw(spark, {})), twice)


def test_lookup_facts(spark):
    # Digits of the id and letters of the names: 19 + 16 + 16.
    facts = inspect_lookup(zones(spark))
    assert facts == LookupFacts(rows=3, text_bytes=51, repeated_keys=0)
    assert facts.fits_broadcast and not LARGE.fits_broadcast
    assert inspect_lookup(zones(spark, [])) == LookupFacts(0, 0, 0)


def test_lookup_from_csv(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(
        "LocationID,Borough,Zone,service_zone\n"
        '1,North,"Harbour, East",Yellow\n'
        "x,South,Market,Boro\n"
    )
    rows = [tuple(r) for r in read_zone_lookup(spark, str(good)).collect()]
    assert rows == [(1, "North", "Harbour, East", "Yellow"), (None, "South", "Market", "Boro")]
    bad = tmp_path / "bad.csv"
    bad.write_text("LocationID,Zone,Borough,service_zone\n1,Harbour,North,Yellow\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_zone_lookup(spark, str(bad)).collect()


def test_layer_schemas_match_the_frames(spark):
    bronze = with_period(with_lineage(raw(spark, {}), "raw", "2024-07-01"))
    std = standardise(bronze)
    silver = with_silver_metadata(
        enrich_with_zones(deduplicate(valid_rows(std)), zones(spark)), "2024-07-01"
    )
    names = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    stored = [*[c for c in silver.columns if c not in ("_year", "_month")], "_year", "_month"]
    assert names(silver.select(stored).schema) == names(SILVER_SCHEMA)
    assert sorted(names(rejected_rows(std).schema), key=str) == sorted(
        names(QUARANTINE_SCHEMA), key=str
    )
    row = silver.first()
    assert (row["_year"], row["_month"], row["_silver_version"]) == ("2024", "01", "1.0")
    assert row["_silver_processed_at"] == datetime(2024, 7, 1)

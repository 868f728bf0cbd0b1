"""The registered queries: every operator and job over the test tables.

All of them read whole tables. Queries that go through storage write what Spark
derives from the tables to the session's work folder and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures
from checks.oracle import RERUN_MONTH, RERUN_YEAR, RUN_TS, SOURCE_PATH
from tierline.functions import exact
from tierline.operators import dedup, enrich, ingest, kpi, quality, reports, standardise
from tierline.plans import jobs
from tierline.plans.config import PipelineConfig
from tierline.plans.ledger import read_ledger
from tierline.session import pin_session, work_folder
from tierline.sinks.catalog import register_gold
from tierline.sinks.tables import write_by_period, write_quarantine
from tierline.sources.census import schema_census
from tierline.sources.lookup import LookupFacts, read_zone_lookup
from tierline.sources.tables import (
    RawInput,
    audited_fields,
    conform,
    in_periods,
    read_bronze,
    read_gold,
    read_layer,
    read_quarantine,
    read_raw_trips,
    read_silver,
)
from tierline.trips import BRONZE_SCHEMA, RAW_SCHEMA, RAW_SCHEMA_OLDER

Query = Callable[[SparkSession, str], DataFrame]

RERUN = ((RERUN_YEAR, RERUN_MONTH),)

# --- frames, built lazily from the given tables ----------------------------


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = ingest.with_lineage(fixtures.trips(spark, sf_dir), SOURCE_PATH, RUN_TS)
    return ingest.with_period(landed)


def standardised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise.standardise(bronze(spark, sf_dir))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.tag(standardised(spark, sf_dir))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicate(quality.valid_rows(standardised(spark, sf_dir)))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_with_zones(deduplicated(spark, sf_dir), fixtures.zones(spark, sf_dir))


def enriched_by_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the lookup is measured as too large to broadcast."""
    large = LookupFacts(rows=10**9, text_bytes=10**11, repeated_keys=0)
    return enrich.enrich_with_zones(
        deduplicated(spark, sf_dir), fixtures.zones(spark, sf_dir), large
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise.with_silver_metadata(enriched(spark, sf_dir), RUN_TS)


def gold(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = kpi.BUILDERS[table](silver(spark, sf_dir), RUN_TS)
        return kpi.in_reading_order(built, table)

    return query


def positions(table: str) -> Query:
    """The keys of a gold table's rows with their places in reading order.

    Rows are numbered as they come out of the sort.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = stored(table)(spark, sf_dir)
        ordered = kpi.in_reading_order(rows, table)
        numbered = kpi.with_position(ordered, work_folder(spark, "ordered"))
        return numbered.select(*kpi.ROW_KEYS[table], "position")

    return query


# --- queries through storage -----------------------------------------------


def typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor 1 in current files and vendor 2 in files of the older types."""
    folder = work_folder(spark, "raw")
    current, older = RawInput(f"{folder}/current"), RawInput(f"{folder}/older", RAW_SCHEMA_OLDER)
    fixtures.trips(spark, sf_dir).filter("VendorID = 1").write.parquet(current.path)
    fixtures.trips_older(spark, sf_dir).filter("VendorID = 2").write.parquet(older.path)
    return read_raw_trips(spark, [current, older])


def zone_lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "zones")
    fixtures.zones(spark, sf_dir).write.option("header", True).csv(folder)
    return read_zone_lookup(spark, folder)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land everything, land one month again with other tips, count per period."""
    folder = work_folder(spark, "bronze")
    rows = bronze(spark, sf_dir)
    write_by_period(rows, folder)
    again = rows.filter(in_periods(RERUN)).withColumn("tip_amount", F.col("tip_amount") + 1)
    write_by_period(again, folder)
    return (
        read_bronze(spark, folder)
        .groupBy("_year", "_month")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("tip_amount").alias("tips"))
    )


def _spoiled(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with other values in the month that is written again."""
    other = F.when(in_periods(RERUN), F.col(column) + 1).otherwise(F.col(column))
    return rows.withColumn(column, other)


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all rejects, those of one period with other values; then that period again."""
    folder = work_folder(spark, "quarantine")
    rejected = quality.rejected_rows(standardised(spark, sf_dir))
    write_quarantine(_spoiled(rejected, "tip_amount"), folder)
    write_quarantine(rejected, folder, RERUN)
    return read_quarantine(spark, folder)


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write silver, one month of it with other values; then that month again."""
    folder = work_folder(spark, "silver")
    rows = silver(spark, sf_dir)
    write_by_period(_spoiled(rows, "tip_amount"), folder, rebalance=True)
    write_by_period(rows.filter(in_periods(RERUN)), folder)
    return read_silver(spark, folder)


def bronze_with_strays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything lands; then one month lands again, from an input of all months, twice.

    Rows and tips by period of bronze and of the strays: each row of the second input
    is in one of them, once.
    """
    folder = work_folder(spark, "strays")
    rows = fixtures.trips(spark, sf_dir)
    first, again = RawInput(f"{folder}/first"), RawInput(f"{folder}/again")
    rows.write.parquet(first.path)
    rows.withColumn("tip_amount", F.col("tip_amount") + 1).write.parquet(again.path)
    cfg = _landing(folder, first)
    jobs.run_bronze(spark, cfg)
    month = replace(cfg, raw=(again,), periods=RERUN, strays=f"{folder}/other")
    for _ in range(2):
        jobs.run_bronze(spark, month)
    tables = {"bronze": read_bronze(spark, cfg.bronze)}
    tables["strays"] = read_layer(spark, month.strays, BRONZE_SCHEMA)
    parts = [
        table.groupBy(F.lit(name).alias("place"), "_year", "_month").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("tip_amount").alias("tips")
        )
        for name, table in tables.items()
    ]
    return parts[0].unionByName(parts[1])


def _landing(folder: str, *raw: RawInput) -> PipelineConfig:
    """Settings of a run that stops after bronze."""
    return PipelineConfig(
        raw=raw,
        zones="",
        bronze=f"{folder}/bronze",
        silver="",
        quarantine="",
        gold="",
        run_ts=RUN_TS,
        null_rate_limit=1.0,
    )


def cast_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landing both generations of files has lost, by column.

    Vendor 1 is in current files, vendor 2 in older ones, some of whose numbers fit no
    column of bronze.
    """
    folder = work_folder(spark, "casts")
    current, older = RawInput(f"{folder}/current"), RawInput(f"{folder}/older", RAW_SCHEMA_OLDER)
    fixtures.trips(spark, sf_dir).filter("VendorID = 1").write.parquet(current.path)
    misfits = fixtures.misfits(spark, sf_dir).filter("VendorID % 1099511627776 = 2")
    misfits.write.parquet(older.path)
    cfg = replace(_landing(folder, current, older), cast_loss_limit=1.0)
    counts = jobs.run_bronze(spark, cfg)
    lines = [
        (name, counts["raw"], counts[f"nulled {name}"], counts[f"changed {name}"])
        for name in audited_fields(cfg.raw, RAW_SCHEMA)
    ]
    return spark.createDataFrame(
        lines, "column_name string, n_rows bigint, nulled bigint, changed bigint"
    )


def _write_files(
    spark: SparkSession,
    rows: DataFrame,
    files: int,
    derive: Callable[[DataFrame], DataFrame],
    folder: str,
) -> dict[str, Callable[[], None]]:
    """Writes of what ``derive`` makes of ``rows`` as so many files of about equal size.

    A file is written by one task. What that task reads are compressed columns, of which every
    task has written a share here, and not shuffled rows, which are several times as many bytes.
    """
    path = work_folder(spark, "shares")
    share = F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int")
    dealt = rows.withColumn("_share", share)
    dealt.write.partitionBy("_share").parquet(path)
    shares = spark.read.schema(dealt.schema).parquet(path)

    def write(k: int) -> None:
        part = shares.filter(F.col("_share") == k).drop("_share").coalesce(1)
        derive(part).write.parquet(f"{folder}-{k}")

    return {f"{folder}-{k}": lambda k=k: write(k) for k in range(files)}


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns by type of a folder in which both generations of files were mixed."""
    folder = work_folder(spark, "mixed")
    items = fixtures.used_columns(fixtures.line_items(spark, sf_dir))
    writes = {}
    for vendor, schema, files in ((1, RAW_SCHEMA, 3), (2, RAW_SCHEMA_OLDER, 2)):

        def derive(part: DataFrame, vendor=vendor, schema=schema) -> DataFrame:
            rows = fixtures.derived_trips(part).filter(F.col("VendorID") == vendor)
            return conform(rows, schema)

        some = fixtures.with_vendor(items, vendor)
        writes |= _write_files(spark, some, files, derive, f"{folder}/file={vendor}")
    jobs._together(spark, writes)
    return schema_census(spark, folder).drop("a_file")


# --- queries over a full run of the pipeline --------------------------------

_RUNS: dict[tuple[str, str], tuple[PipelineConfig, dict[str, int]]] = {}


def stored_config(spark: SparkSession, sf_dir: str, copies: int = 1) -> PipelineConfig:
    """Raw trips and lookup as files, and the settings of a run over them.

    Raw files arrive by time, so each holds a stretch of it.
    """
    folder = work_folder(spark, "run")
    if copies == 1:
        raw = fixtures.trips_by_time(spark, sf_dir)
    else:
        spread = fixtures.spread(fixtures.trips(spark, sf_dir), copies)
        raw = spread.repartitionByRange("tpep_pickup_datetime")
    raw.write.parquet(f"{folder}/raw")
    fixtures.zones(spark, sf_dir).write.option("header", True).csv(f"{folder}/zones")
    return PipelineConfig(
        raw=(RawInput(f"{folder}/raw"),),
        zones=f"{folder}/zones",
        bronze=f"{folder}/bronze",
        silver=f"{folder}/silver",
        quarantine=f"{folder}/quarantine",
        gold=f"{folder}/gold",
        run_ts=RUN_TS,
        database=f"gold_{folder[-12:]}",
    )


def pipeline_run(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, dict[str, int]]:
    """One full run per session and input, shared by the queries over its tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        cfg = stored_config(spark, sf_dir)
        cfg = replace(cfg, ledger=f"{cfg.gold}-ledger", run_id="shared")
        _RUNS[key] = cfg, jobs.run_pipeline(spark, cfg)
    return _RUNS[key]


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the full run has recorded of its steps, after a repeat that skips them."""
    cfg, counts = pipeline_run(spark, sf_dir)
    again = jobs.run_pipeline(spark, cfg)
    if again != counts:
        raise ValueError(f"a repeat reports {again}, the run {counts}")
    return read_ledger(spark, cfg.ledger).drop("run", "step")


def stored(table: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg, _ = pipeline_run(spark, sf_dir)
        return read_gold(spark, cfg.gold, table)

    return query


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and trips per period of each registered gold table."""
    cfg, _ = pipeline_run(spark, sf_dir)
    parts = [
        spark.table(name)
        .groupBy("_year", "_month")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("total_trips").alias("trips"))
        .select(F.lit(name.split("`")[-2]).alias("table_name"), "_year", "_month", "n_rows", "trips")
        for name in register_gold(spark, cfg.gold, cfg.database)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def revenue_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_zone(stored("daily_revenue_by_zone")(spark, sf_dir))


def top_zones_by_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = pipeline_run(spark, sf_dir)
    table = f"{cfg.database}.daily_revenue_by_zone"
    return reports.top_zones(spark, int(RERUN_YEAR), int(RERUN_MONTH), table=table)


def peak_weekday_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = pipeline_run(spark, sf_dir)
    return reports.peak_weekday_hours(
        spark, int(RERUN_YEAR), table=f"{cfg.database}.hourly_demand"
    )


def period_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run over one month's other values, then all layers of that month again.

    The daily table after it.
    """
    cfg = stored_config(spark, sf_dir)
    right, wrong = cfg.raw[0], RawInput(f"{work_folder(spark, 'raw')}/wrong")
    months = ingest.with_period(read_raw_trips(spark, [right]))
    _spoiled(months, "total_amount").drop("_year", "_month").write.parquet(wrong.path)
    jobs.run_pipeline(spark, replace(cfg, raw=(wrong,)))
    month = replace(cfg, periods=RERUN, strays=f"{cfg.bronze}-strays")
    for job in (jobs.run_bronze, jobs.run_silver, jobs.run_gold):
        job(spark, month)
    return read_gold(spark, cfg.gold, "daily_revenue_by_zone")


def rejected_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full run, then one month lands again with trips that all break a rule.

    Rows by layer and period: the month is in quarantine and nowhere else.
    """
    cfg = stored_config(spark, sf_dir)
    jobs.run_pipeline(spark, cfg)
    again = RawInput(f"{work_folder(spark, 'raw')}/again")
    trips_again = ingest.with_period(fixtures.trips(spark, sf_dir)).filter(in_periods(RERUN))
    wrong = trips_again.withColumn("trip_distance", F.lit(-1.0)).drop("_year", "_month")
    wrong.write.parquet(again.path)
    month = replace(cfg, periods=RERUN, raw=(again,), null_rate_limit=1.0)
    jobs.run_bronze(spark, month)
    jobs.run_silver(spark, month)
    jobs.run_gold(spark, month)
    daily = read_gold(spark, cfg.gold, "daily_revenue_by_zone")
    layers = {
        "silver": read_silver(spark, cfg.silver).withColumn("n", F.lit(1).cast("long")),
        "quarantine": read_quarantine(spark, cfg.quarantine).withColumn("n", F.lit(1).cast("long")),
        "gold": daily.withColumns(
            {
                "n": F.col("total_trips"),
                "_year": F.col("_year").cast("string"),
                "_month": F.lpad(F.col("_month").cast("string"), 2, "0"),
            }
        ),
    }
    parts = [
        layer.groupBy(F.lit(name).alias("layer"), "_year", "_month").agg(F.sum("n").alias("n_rows"))
        for name, layer in layers.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def fine_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and averages of values with six decimals."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    values = items.select(
        "l_returnflag", "l_linestatus", (F.col("l_partkey") / F.lit(1e6)).alias("x")
    )
    sums = values.groupBy("l_returnflag", "l_linestatus").agg(*exact.partials(["x"]))
    return sums.select(
        "l_returnflag",
        "l_linestatus",
        exact.total("x").alias("total"),
        exact.average("x", 4).alias("average"),
    )


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, counts = pipeline_run(spark, sf_dir)
    return jobs.counts_frame(spark, counts)


_QUERIES: dict[str, Query] = {
    "typed_scan": typed_scan,
    "zone_lookup_csv": zone_lookup_csv,
    "bronze_lineage": bronze,
    "bronze_null_gate": lambda s, d: ingest.null_rates(fixtures.trips(s, d)),
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_with_strays": bronze_with_strays,
    "cast_audit": cast_audit,
    "schema_census": census,
    "standardised": standardised,
    "dq_tagged": tagged,
    "dq_issue_counts": lambda s, d: quality.issue_counts(tagged(s, d)),
    "dq_split_summary": lambda s, d: quality.split_summary(tagged(s, d)),
    "quarantine": lambda s, d: quality.rejected_rows(standardised(s, d)),
    "quarantine_roundtrip": quarantine_roundtrip,
    "dedup": deduplicated,
    "enriched": enriched,
    "enriched_by_shuffle": enriched_by_shuffle,
    "silver": silver,
    "silver_roundtrip": silver_roundtrip,
    "daily_revenue_by_zone": gold("daily_revenue_by_zone"),
    "hourly_demand": gold("hourly_demand"),
    "payment_type_summary": gold("payment_type_summary"),
    "daily_stored": stored("daily_revenue_by_zone"),
    "hourly_stored": stored("hourly_demand"),
    "payment_stored": stored("payment_type_summary"),
    "daily_positions": positions("daily_revenue_by_zone"),
    "hourly_positions": positions("hourly_demand"),
    "payment_positions": positions("payment_type_summary"),
    "gold_roundtrip": gold_roundtrip,
    "revenue_by_zone": revenue_by_zone,
    "top_zones_by_revenue": top_zones_by_revenue,
    "peak_weekday_hours": peak_weekday_hours,
    "hourly_top5": lambda s, d: reports.preview_hourly(
        kpi.hourly_demand(silver(s, d), RUN_TS)
    ),
    "preview_bronze": lambda s, d: reports.preview_bronze(bronze(s, d)),
    "preview_silver": lambda s, d: reports.preview_silver(silver(s, d)),
    "preview_daily": lambda s, d: reports.preview_daily(
        kpi.daily_revenue_by_zone(silver(s, d), RUN_TS)
    ),
    "preview_payments": lambda s, d: reports.preview_payments(
        kpi.payment_type_summary(silver(s, d), RUN_TS)
    ),
    "period_rerun": period_rerun,
    "rejected_month": rejected_month,
    "fine_decimals": fine_decimals,
    "stage_counts": stage_counts,
    "run_ledger": run_ledger,
}


def _pinned(query: Query) -> Query:
    return lambda spark, sf_dir: query(pin_session(spark), sf_dir)


def registered() -> dict[str, Query]:
    return {name: _pinned(query) for name, query in _QUERIES.items()}

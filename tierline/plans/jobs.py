"""The layer jobs. Each returns its row counts, taken while writing."""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import replace
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tierline.operators import kpi, reports
from tierline.operators.dedup import deduplicate
from tierline.operators.enrich import enrich_with_zones
from tierline.operators.ingest import enforce_casts, enforce_gate, with_lineage, with_period
from tierline.operators.quality import rejected_rows, valid_rows
from tierline.operators.standardise import standardise, with_silver_metadata
from tierline.plans.config import PipelineConfig, period_label
from tierline.plans.ledger import Entry, Ledger
from tierline.session import pin_session
from tierline.sinks.catalog import register_gold
from tierline.sinks.files import Folders, period_folder
from tierline.sinks.landing import (
    Staged,
    discard,
    move_in,
    move_in_together,
    rows_by_period,
    stage,
    write_strays,
)
from tierline.sinks.tables import empty_periods, write_gold
from tierline.sources.census import check_files
from tierline.sources.lookup import LookupFacts, checked_lookup, read_zone_lookup
from tierline.sources.tables import (
    Period,
    audit_columns,
    audited_fields,
    loss_counts,
    read_bronze,
    read_gold,
    read_raw_trips,
    read_silver,
    stored_periods,
)
from tierline.trips import PERIOD, RAW_SCHEMA

Counts = dict[str, int]
Written = TypeVar("Written")


def _together(
    spark: SparkSession, writes: dict[str, Callable[[], Written]], at_once: int | None = None
) -> dict[str, Written]:
    """Run independent writes at the same time; the first failure ends them all.

    Tasks of one fill the cores that another leaves idle at its end and while the
    driver commits its files. When one fails, the jobs of the others are
    cancelled and waited for, and the failure that came first is raised.
    """
    in_session = inheritable_thread_target(spark)
    tag = f"tierline-{uuid.uuid4().hex}"
    ended = threading.Event()

    def tagged(write: Callable[[], Written]) -> Callable[[], Written]:
        def run() -> Written:
            if ended.is_set():
                raise RuntimeError("not begun, as another write had failed")
            spark.sparkContext.addJobTag(tag)
            return write()

        return run

    with ThreadPoolExecutor(max_workers=at_once or len(writes)) as pool:
        running = {name: pool.submit(in_session(tagged(w))) for name, w in writes.items()}
        done, rest = wait(running.values(), return_when=FIRST_EXCEPTION)
        failed = [f for f in done if f.exception() is not None]
        if failed:
            ended.set()
            while rest:  # a write may start further jobs after it was cancelled
                spark.sparkContext.cancelJobsWithTag(tag)
                rest = wait(rest, timeout=1).not_done
            raise failed[0].exception()
        return {name: future.result() for name, future in running.items()}


def bronze_frame(spark: SparkSession, cfg: PipelineConfig, audit: bool = False) -> DataFrame:
    """Typed raw trips with lineage and period, one source path per input."""
    parts = [
        with_lineage(
            read_raw_trips(spark, [i], audit=audit), i.path, cfg.run_ts, cfg.source_system
        )
        for i in cfg.raw
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return with_period(whole)


def silver_frame(
    standardised: DataFrame,
    zones: DataFrame,
    cfg: PipelineConfig,
    facts: LookupFacts | None = None,
    small_months: bool = False,
) -> DataFrame:
    """Valid, deduplicated and enriched trips from standardised ones.

    One shuffle deals the trips. That of ``small_months`` deals them by month, so that a
    month is written by one task; otherwise by trip, and any number of tasks write a month.
    """
    dealt_by = PERIOD if small_months else ()
    trips_once = deduplicate(valid_rows(standardised, cfg.rules), dealt_by=dealt_by)
    enriched = enrich_with_zones(trips_once, zones, facts or checked_lookup(zones))
    return with_silver_metadata(enriched, cfg.run_ts, cfg.silver_version)


def run_bronze(spark: SparkSession, cfg: PipelineConfig) -> Counts:
    """Check each raw input and land it. When a check fails, bronze stays as it was.

    Files are compared with the schema of their input, NULLs are counted, and all rows
    are then written beside bronze, by period. The rows of each period and the values
    that casts have changed, counted on the way, decide whether the periods are moved
    in; see ``PipelineConfig`` for what a run accepts. Rows are read twice, five
    columns for the gate and all of them for the write.
    """
    pin_session(spark)
    ledger = _ledger(spark, cfg)
    step = f"bronze-{cfg.run_key}"
    if ledger and (done := ledger.finished(step)) is not None:
        return done
    rows = 0
    for source in cfg.raw:
        if cfg.check_files:
            check_files(spark, source)
        gate = enforce_gate(
            read_raw_trips(spark, [source]), cfg.critical_columns, cfg.null_rate_limit
        )
        rows += gate[0]["total_rows"]
    audited = audited_fields(cfg.raw, RAW_SCHEMA)
    hidden = audit_columns(RAW_SCHEMA) if audited else []
    frame = bronze_frame(spark, cfg, audit=bool(audited))
    staged = stage(
        frame,
        cfg.bronze,
        cfg.run_key,
        observe=loss_counts(audited, RAW_SCHEMA),
        hidden=hidden,
        rebalance=cfg.rebalance_bronze,
    )
    counts = {"raw": rows, **staged.observed}
    try:
        enforce_casts(staged.observed, rows, cfg.cast_loss_limit)
        periods = _landed_periods(spark, cfg, staged)
        if cfg.periods is not None:
            outside = sum(n for p, n in staged.rows.items() if p not in periods)
            if outside and cfg.strays is None:
                raise StrayRows(f"{outside} input row(s) outside of the periods of this run")
            if cfg.strays is not None:
                counts["strays"] = write_strays(staged, frame.drop(*hidden), cfg.strays, periods)
            else:
                counts["strays"] = 0
    except ValueError:
        discard(staged)
        raise
    counts["bronze"] = move_in(staged, periods)
    if ledger:
        entries = [Entry(layer, None, n) for layer, n in counts.items() if layer != "bronze"]
        entries += [Entry("bronze", p, staged.rows.get(p, 0)) for p in periods]
        ledger.finish(step, entries)
    if cfg.previews:
        _sample(read_bronze(spark, cfg.bronze, cfg.periods), reports.BRONZE_PREVIEW)
    return counts


def _ledger(spark: SparkSession, cfg: PipelineConfig) -> Ledger | None:
    """Where this run keeps what it has finished, if it is to."""
    if cfg.ledger is None or cfg.run_id is None:
        return None
    return Ledger(spark, cfg.ledger.rstrip("/"), cfg.run_id)


def _landed_periods(spark: SparkSession, cfg: PipelineConfig, staged: Staged) -> list[Period]:
    """The periods to move in, none of which may lose rows unasked."""
    if cfg.periods is not None:
        empty = [p for p in cfg.periods if not staged.rows.get(p)]
        if empty and not cfg.allow_empty:
            raise EmptyPeriods(f"the input has no row of {_named(empty)}")
        return list(dict.fromkeys(cfg.periods))
    periods = list(staged.rows)
    if not cfg.allow_shrinking and Folders(spark, cfg.bronze).exists():
        stored = rows_by_period(read_bronze(spark, cfg.bronze))
        fewer = [p for p in periods if staged.rows[p] < stored.get(p, 0)]
        if fewer:
            raise ShrinkingPeriods(
                f"the input has fewer rows than are stored of {_named(fewer)}; name the "
                "periods of the run to replace them"
            )
    return periods


def _named(periods: list[Period]) -> str:
    return ", ".join("-".join(map(str, p)) if p != (None, None) else "no period" for p in periods)


class StrayRows(ValueError):
    """The input of a run over some periods has rows of others."""


class EmptyPeriods(ValueError):
    """The input of a run over some periods has no rows of one of them."""


class ShrinkingPeriods(ValueError):
    """A run without named periods would replace a month by fewer rows."""


def _sample(layer: DataFrame, columns: tuple[str, ...], n: int = 5) -> None:
    """Print some rows of a layer; reading stops when there are enough."""
    layer.select(*columns).limit(n).show(truncate=False)


def month_batches(rows: dict[Period, int], most: int) -> list[tuple[Period, ...]]:
    """Months in order, put together as long as a batch has ``most`` rows at the most."""
    batches: list[list[Period]] = []
    size = 0
    for period in sorted(rows, key=lambda p: tuple(map(str, p))):
        if not batches or size + rows[period] > most:
            batches.append([])
            size = 0
        batches[-1].append(period)
        size += rows[period]
    return [tuple(batch) for batch in batches]


def run_silver(spark: SparkSession, cfg: PipelineConfig) -> Counts:
    """Build silver and quarantine from bronze, in batches of months.

    The pickup time is part of the trip key and gives the month, so copies of a trip
    never lie in two batches. Each batch has one shuffle of its trips: neighbouring
    small months are dealt by month, a large month by trip and with copies cut on both
    sides of the shuffle. Files follow a month's size either way. Batches run side by side.

    Silver and quarantine of a batch are both written beside their tables and then moved
    in together. The periods of the run, or all stored ones, are replaced also where no row
    is left in them. Rows of each month come from the file footers, and that of valid rows
    from them and the rejects, so neither is counted below a shuffle.
    """
    pin_session(spark)
    rows = rows_by_period(read_bronze(spark, cfg.bronze, cfg.periods))
    zones = read_zone_lookup(spark, cfg.zones)
    facts = checked_lookup(zones)
    batches = {
        f"silver-{period_label(batch)}": batch for batch in month_batches(rows, cfg.batch_rows)
    }
    steps = {
        step: lambda step=step, batch=batch: _clean(
            spark, cfg, step, silver_batch(spark, cfg, zones, facts, batch), rows, batch
        )
        for step, batch in batches.items()
    }
    written = _together(spark, steps, cfg.batches_at_once) if steps else {}
    found = {period_folder(p) for p in rows}
    named = None if cfg.periods is None else {period_folder(p) for p in cfg.periods}
    for path in (cfg.silver, cfg.quarantine):
        Folders(spark, path).make("")
        empty_periods(spark, path, lambda p: p not in found and (named is None or p in named))
    if cfg.previews:
        _sample(read_silver(spark, cfg.silver, cfg.periods), reports.SILVER_PREVIEW)
    return {
        layer: sum(counts[layer] for counts in written.values())
        for layer in ("valid", "rejected", "silver")
    }


def _clean(
    spark: SparkSession,
    cfg: PipelineConfig,
    step: str,
    silver: DataFrame,
    rows: dict[Period, int],
    batch: tuple[Period, ...],
) -> Counts:
    """Write and move in silver and quarantine of one batch; both tables change, or none."""
    ledger = _ledger(spark, cfg)
    if ledger and (done := ledger.finished(step)) is not None:
        return done
    bronze = standardise(read_bronze(spark, cfg.bronze, batch))
    rejected = rejected_rows(bronze, cfg.rules)
    staged = _together(
        spark,
        {
            "silver": lambda: stage(silver, cfg.silver, step),
            "rejected": lambda: stage(rejected, cfg.quarantine, step, rebalance=True),
        },
    )
    move_in_together([(table, batch) for table in staged.values()])
    layers = {name: {p: table.rows.get(p, 0) for p in batch} for name, table in staged.items()}
    layers["valid"] = {p: rows[p] - layers["rejected"][p] for p in batch}
    if ledger:
        ledger.finish(
            step,
            (Entry(name, p, n, n / rows[p]) for name, by in layers.items() for p, n in by.items()),
        )
    return {name: sum(by.values()) for name, by in layers.items()}


def silver_batch(
    spark: SparkSession,
    cfg: PipelineConfig,
    zones: DataFrame,
    facts: LookupFacts,
    periods: Sequence[Period],
) -> DataFrame:
    """Silver of some months, as it is written."""
    bronze = read_bronze(spark, cfg.bronze, periods)
    return silver_frame(standardise(bronze), zones, cfg, facts, small_months=len(periods) > 1)


def run_gold(spark: SparkSession, cfg: PipelineConfig) -> Counts:
    """Build the three gold tables, each from its own columns of silver."""
    pin_session(spark)
    ledger, step = _ledger(spark, cfg), f"gold-{period_label(cfg.periods)}"
    if ledger and (done := ledger.finished(step)) is not None:
        return done
    silver = read_silver(spark, cfg.silver, cfg.periods)

    def writer(table: str) -> Callable[[], int]:
        built = kpi.BUILDERS[table](silver, cfg.run_ts)
        return lambda: write_gold(built, cfg.gold, table, replace=cfg.gold_periods or "all")

    counts = _together(spark, {table: writer(table) for table in kpi.BUILDERS})
    if ledger:
        ledger.finish(step, (Entry(table, None, n) for table, n in counts.items()))
    if cfg.previews:
        for table, show in (
            ("daily_revenue_by_zone", reports.preview_daily),
            ("hourly_demand", reports.preview_hourly),
            ("payment_type_summary", reports.preview_payments),
        ):
            show(read_gold(spark, cfg.gold, table, cfg.gold_periods)).show(truncate=False)
    return counts


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> Counts:
    """Bronze, silver, gold and registration in order; a failure ends the run.

    With a ledger and a run id, a repeat under that id skips what had been finished.
    """
    counts = run_bronze(spark, cfg)
    counts |= run_silver(spark, cfg)
    counts |= run_gold(spark, cfg)
    register_gold(spark, cfg.gold, cfg.database, cfg.gold_periods)
    return counts


def run_backfill(spark: SparkSession, cfg: PipelineConfig, months: int = 1) -> Counts:
    """Silver and gold for everything in bronze, some months at a time.

    The result is that of one run over all periods. Each step shuffles its months
    only, so the largest shuffle is that of the largest batch, and a run that was
    interrupted goes on by repeating one batch (give the remaining ``periods``).
    """
    periods = cfg.periods or stored_periods(read_bronze(spark, cfg.bronze))
    total: Counter[str] = Counter()
    for first in range(0, len(periods), months):
        batch = replace(cfg, periods=tuple(periods[first : first + months]))
        total.update(run_silver(spark, batch))
        total.update(run_gold(spark, batch))
    register_gold(spark, cfg.gold, cfg.database, cfg.gold_periods)
    return dict(total)


def counts_frame(spark: SparkSession, counts: Counts) -> DataFrame:
    """Row counts of a run as a table, one row per stage."""
    return spark.createDataFrame(list(counts.items()), "stage string, n_rows bigint")

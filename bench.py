"""Times the layer jobs and the operators; prints one JSON line.

``BENCH_SF_DIR`` names the input tables, ``BENCH_CPUS`` the local cores and
``BENCH_MEMORY`` the memory of the JVM. ``BENCH_COPIES`` repeats the trips at other
moments for a larger run (34 give 20.8 million trips at sf0.1).

The raw trips and the lookup are written before the clock starts, as they are an
input. Jobs write their tables. Each operator then reads the stored layer it works
on and is run to its full result (``noop`` sink).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from checks.queries import stored_config  # noqa: E402
from tierline.operators import dedup, ingest, kpi, quality, reports, standardise  # noqa: E402
from tierline.plans import jobs  # noqa: E402
from tierline.plans.config import PipelineConfig  # noqa: E402
from tierline.sinks.catalog import register_gold  # noqa: E402
from tierline.sources.lookup import read_zone_lookup  # noqa: E402
from tierline.sources.tables import read_bronze, read_raw_trips, read_silver  # noqa: E402


def operators(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Callable[[], DataFrame]]:
    """Headline queries over the stored layers of a run."""
    raw = read_raw_trips(spark, cfg.raw)
    bronze = read_bronze(spark, cfg.bronze)
    std = standardise.standardise(bronze)
    tagged = quality.tag(std)
    zones = read_zone_lookup(spark, cfg.zones)
    silver = read_silver(spark, cfg.silver)
    daily, hourly = (f"{cfg.database}.{t}" for t in ("daily_revenue_by_zone", "hourly_demand"))
    return {
        "typed_scan": lambda: raw,
        "bronze_null_gate": lambda: ingest.null_rates(raw),
        "bronze_lineage": lambda: jobs.bronze_frame(spark, cfg),
        "standardised": lambda: std,
        "dq_tagged": lambda: tagged,
        "dq_issue_counts": lambda: quality.issue_counts(tagged),
        "dq_split_summary": lambda: quality.split_summary(tagged),
        "quarantine": lambda: quality.rejected_rows(std),
        "dedup": lambda: dedup.deduplicate(quality.valid_rows(std)),
        "silver": lambda: jobs.silver_frame(std, zones, cfg),
        **{
            table: lambda build=build: build(silver, cfg.run_ts)
            for table, build in kpi.BUILDERS.items()
        },
        "top_zones_by_revenue": lambda: reports.top_zones(spark, 2022, 3, table=daily),
        "peak_weekday_hours": lambda: reports.peak_weekday_hours(spark, 2022, table=hourly),
        "preview_silver": lambda: reports.preview_silver(silver),
    }


def session(cpus: str) -> SparkSession:
    shared = tempfile.mkdtemp(prefix="tierline-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tierline-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(action) -> tuple[float, object]:
    start = time.perf_counter()
    result = action()
    return round(time.perf_counter() - start, 3), result


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()

    cfg = stored_config(spark, sf_dir, int(os.environ.get("BENCH_COPIES", "1")))
    seconds, counts = {}, {}
    for name, job in (
        ("job_bronze", jobs.run_bronze),
        ("job_silver", jobs.run_silver),
        ("job_gold", jobs.run_gold),
    ):
        seconds[name], job_counts = timed(lambda: job(spark, cfg))
        counts |= job_counts
    seconds["job_register"], _ = timed(lambda: register_gold(spark, cfg.gold, cfg.database))

    for name, query in operators(spark, cfg).items():
        seconds[name], _ = timed(
            lambda: query().write.format("noop").mode("overwrite").save()
        )

    rates = {
        "bronze": counts["bronze"] / seconds["job_bronze"],
        "silver": (counts["valid"] + counts["rejected"]) / seconds["job_silver"],
        "gold": counts["silver"] / seconds["job_gold"],
    }
    line = {
        "metric": "total time of layer jobs and headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "rows": counts,
        "rows_per_sec": {layer: round(rate) for layer, rate in rates.items()},
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

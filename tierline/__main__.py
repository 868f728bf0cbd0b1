"""Command line of the jobs: ``spark-submit run.py <job> --raw ... --gold ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tierline.plans import jobs
from tierline.plans.config import PipelineConfig
from tierline.sinks.catalog import register_gold
from tierline.sources.census import check_files, schema_census
from tierline.sources.tables import RawInput, schema_drift
from tierline.trips import RAW_SCHEMA_OLDER, quality_rules

JOBS = {
    "bronze": jobs.run_bronze,
    "silver": jobs.run_silver,
    "gold": jobs.run_gold,
    "pipeline": jobs.run_pipeline,
    "backfill": jobs.run_backfill,
}


#: Paths that each job needs.
NEEDS = {
    "bronze": ("raw", "bronze"),
    "silver": ("zones", "bronze", "silver", "quarantine"),
    "gold": ("silver", "gold"),
    "pipeline": ("raw", "zones", "bronze", "silver", "quarantine", "gold"),
    "backfill": ("zones", "bronze", "silver", "quarantine", "gold"),
    "register": ("gold",),
    "drift": ("raw",),
}


def _period(text: str) -> tuple[str | None, str | None]:
    """``2024-02``, or ``none`` for rows without a pickup time."""
    if text == "none":
        return None, None
    year, month = text.split("-")
    return year, f"{int(month):02d}"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tierline")
    p.add_argument("job", choices=[*JOBS, "register", "drift"])
    p.add_argument("--raw", action="append", default=[], help="folder of raw files; repeatable")
    p.add_argument(
        "--raw-older", action="append", default=[], help="folder of raw files with the older types"
    )
    for name in ("zones", "bronze", "silver", "quarantine", "gold"):
        p.add_argument(f"--{name}", help=f"path of the {name} table")
    p.add_argument("--strays", help="table for input rows outside of the periods")
    p.add_argument("--months", type=int, default=1, help="months of a backfill batch")
    p.add_argument("--period", action="append", type=_period, help="YYYY-MM or none; repeatable")
    p.add_argument("--run-ts", help="time recorded on the rows, UTC; default now")
    p.add_argument("--database", help="catalog database of the gold tables")
    p.add_argument("--min-year", type=int)
    p.add_argument("--max-year", type=int)
    p.add_argument("--null-rate-limit", type=float)
    p.add_argument("--cast-loss-limit", type=float, help="share of values a cast may change")
    p.add_argument("--allow-empty", action="store_true", help="empty periods without input rows")
    p.add_argument("--allow-shrinking", action="store_true", help="replace months by fewer rows")
    p.add_argument("--rebalance-bronze", action="store_true")
    p.add_argument("--previews", action="store_true")
    return p


def arguments(argv: list[str] | None) -> argparse.Namespace:
    """Parsed arguments; a path that the job needs and nobody gave is an error."""
    p = parser()
    args = p.parse_args(argv)
    given = {"raw": args.raw or args.raw_older}
    missing = [n for n in NEEDS[args.job] if not given.get(n, getattr(args, n))]
    if missing:
        p.error(f"{args.job} needs {', '.join(f'--{n}' for n in missing)}")
    if args.months < 1:
        p.error("--months must be 1 or more")
    return args


def config(args: argparse.Namespace) -> PipelineConfig:
    years = {k: getattr(args, k) for k in ("min_year", "max_year") if getattr(args, k) is not None}
    given = {
        "run_ts": args.run_ts,
        "null_rate_limit": args.null_rate_limit,
        "cast_loss_limit": args.cast_loss_limit,
        "periods": tuple(args.period) if args.period else None,
    }
    return PipelineConfig(
        raw=(
            *(RawInput(path) for path in args.raw),
            *(RawInput(path, RAW_SCHEMA_OLDER) for path in args.raw_older),
        ),
        zones=args.zones or "",
        bronze=args.bronze or "",
        silver=args.silver or "",
        quarantine=args.quarantine or "",
        gold=args.gold or "",
        rules=quality_rules(**years),
        database=args.database,
        strays=args.strays,
        allow_empty=args.allow_empty,
        allow_shrinking=args.allow_shrinking,
        rebalance_bronze=args.rebalance_bronze,
        previews=args.previews,
        **{name: value for name, value in given.items() if value is not None},
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    cfg = config(args)
    spark = SparkSession.builder.appName(f"tierline-{args.job}").getOrCreate()
    if args.job == "register":
        print(json.dumps(register_gold(spark, cfg.gold, cfg.database)))
    elif args.job == "drift":
        for source in cfg.raw:
            schema_census(spark, source.path).orderBy("column_name", "type").show(1000, truncate=False)
            check_files(spark, source)
            schema_drift(spark, source.path, source.file_schema).show(100, truncate=False)
    elif args.job == "backfill":
        print(json.dumps(jobs.run_backfill(spark, cfg, args.months)))
    else:
        print(json.dumps(JOBS[args.job](spark, cfg)))


if __name__ == "__main__":
    main()

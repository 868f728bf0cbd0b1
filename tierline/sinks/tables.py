"""Writers that can be run again.

Each takes care never to write a path the frame still reads; layers live under
different paths.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.sinks.files import NULL_PARTITION, Folders, period_folder
from tierline.sources.tables import Period, in_periods
from tierline.trips import PERIOD


def by_period(df: DataFrame) -> DataFrame:
    """Bring the rows of a period together, in as many tasks as they need.

    A rebalance, not a repartition: adaptive execution joins small periods and
    splits large ones, so that file sizes follow
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and a period with a third
    of all rows is written by many tasks.
    """
    return df.hint("rebalance", *(F.col(name) for name in PERIOD))


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the written rows on the way.

    The observation sits on top of the plan, in the stage that writes. Spark takes
    the metrics of each partition of that stage once, also when a task is run
    again after an executor is lost; below a shuffle that would not hold.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen


def _rows(seen: Observation) -> int:
    return seen.get.get("n_rows", 0)


def write_by_period(
    df: DataFrame,
    path: str,
    rebalance: bool = False,
    replace: Sequence[Period] | str | None = None,
) -> int:
    """Replace the periods present in ``df``; returns rows written.

    Periods without rows in ``df`` stay, unless ``replace`` names them: a list of
    periods, or ``"all"`` for every period that is stored. Those are emptied after
    the write has been committed.
    """
    return _write_periods(by_period(df) if rebalance else df, path, replace)


def write_gold(
    df: DataFrame, root: str, table: str, replace: Sequence[Period] | str | None = None
) -> int:
    """A gold table: few, sorted files per period; ``replace`` as in :func:`write_by_period`."""
    laid_out = by_period(df)
    order = [*PERIOD, *(c for c in df.columns if c not in (*PERIOD, "processed_at"))]
    path = f"{root.rstrip('/')}/{table}"
    return _write_periods(laid_out.sortWithinPartitions(*order), path, replace)


def _write_periods(df: DataFrame, path: str, replace: Sequence[Period] | str | None) -> int:
    seen = Observation()
    folder = F.concat_ws(
        "/",
        *(
            F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit(NULL_PARTITION)))
            for k in PERIOD
        ),
    )
    # One entry for each period that is written.
    counted = df.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.collect_set(folder).alias("folders")
    )
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PERIOD)
        .parquet(path)
    )
    if replace is not None:
        written = set(seen.get.get("folders") or ())
        named = None if replace == "all" else {period_folder(p) for p in replace}
        empty_periods(
            df.sparkSession,
            path,
            lambda found: found not in written and (named is None or found in named),
        )
    return _rows(seen)


def empty_periods(spark: SparkSession, path: str, unwanted: Callable[[str], bool]) -> None:
    """Delete the folders of stored periods that ``unwanted`` holds for."""
    folders = Folders(spark, path)
    for period in list(folders.periods()):
        if unwanted(period):
            folders.delete(period)


def write_quarantine(
    rejected: DataFrame, path: str, periods: Sequence[Period] | None = None
) -> int:
    """Replace the rejected rows of the whole table, or of the listed periods.

    The write happens even when there are none, so rejects of an earlier run do
    not stay behind.
    """
    if periods is not None:
        rows = rejected.filter(in_periods(periods))
        return _write_periods(by_period(rows), path, replace=periods)
    counted, seen = _counted(by_period(rejected))
    (
        counted.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*PERIOD)
        .parquet(path)
    )
    return _rows(seen)

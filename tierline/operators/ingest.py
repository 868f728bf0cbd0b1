"""Bronze: lineage, period keys and the null-rate gate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from tierline import trips
from tierline.functions.calendar import period_columns, run_time


def with_lineage(
    df: DataFrame,
    source_path: str,
    run_ts: datetime | str,
    source_system: str = trips.SOURCE_SYSTEM,
    per_file: bool = False,
) -> DataFrame:
    """Add when, from which system and from which path the rows came.

    ``per_file`` records the file of each row instead of the input folder; it
    needs a frame that still sits directly on its scan.
    """
    path = F.col("_metadata.file_path") if per_file else F.lit(source_path)
    return df.withColumns(
        {
            "_ingested_at": run_time(run_ts),
            "_source_system": F.lit(source_system),
            "_source_path": path,
        }
    )


def with_period(df: DataFrame, moment: str = "tpep_pickup_datetime") -> DataFrame:
    """Add the period keys; rows without the moment get NULL keys."""
    return df.withColumns(period_columns(moment))


class GateFailed(ValueError):
    """The input is not fit to be landed."""


class LossyCast(ValueError):
    """Casts of the landing have lost more values than a run allows."""


def enforce_casts(losses: dict[str, int], rows: int, limit: float) -> None:
    """Raise ``LossyCast`` where a column has lost more than ``limit`` of all rows.

    ``losses`` has ``nulled <column>`` and ``changed <column>``.
    """
    columns = dict.fromkeys(name.split(" ", 1)[1] for name in losses)
    broken = []
    for name in columns:
        nulled, changed = losses.get(f"nulled {name}", 0), losses.get(f"changed {name}", 0)
        if nulled + changed > limit * rows:
            broken.append(f"{name}: {nulled} made NULL, {changed} changed, of {rows}")
    if broken:
        raise LossyCast(f"values do not fit the columns they land in; {'; '.join(broken)}")


def null_counts(df: DataFrame, columns: Sequence[str] = trips.CRITICAL_COLUMNS) -> DataFrame:
    """One row: ``total`` and the NULLs of each column, from a single pass.

    Only counts are asked for, so the scan reads these columns and nothing else
    (and may answer from the file footers where Spark is set up to do so).
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), *(F.count(F.col(c)).alias(c) for c in columns)
    )
    return counted.select("total", *((F.col("total") - F.col(c)).alias(c) for c in columns))


def null_rates(
    df: DataFrame,
    columns: Sequence[str] = trips.CRITICAL_COLUMNS,
    limit: float = trips.NULL_RATE_LIMIT,
) -> DataFrame:
    """The gate as a table: ``column_name, total_rows, null_rows, null_rate, passed``.

    With no rows at all the rate is NULL and nothing passes.
    """
    lines = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows"))
            for c in columns
        )
    )
    rate = F.try_divide(F.col("null_rows"), F.col("total_rows"))
    return (
        null_counts(df, columns)
        .select(F.col("total").alias("total_rows"), F.inline(lines))
        .select(
            "column_name",
            "total_rows",
            "null_rows",
            rate.alias("null_rate"),
            F.coalesce(rate <= F.lit(limit), F.lit(False)).alias("passed"),
        )
    )


def enforce_gate(
    df: DataFrame,
    columns: Sequence[str] = trips.CRITICAL_COLUMNS,
    limit: float = trips.NULL_RATE_LIMIT,
) -> list[Row]:
    """Run the gate and raise ``GateFailed`` on a breach; returns its rows.

    One row per watched column reaches the driver.
    """
    lines = null_rates(df, columns, limit).collect()
    if lines[0]["total_rows"] == 0:
        raise GateFailed("the input has no rows")
    broken = [line for line in lines if not line["passed"]]
    if broken:
        shares = ", ".join(
            f"{b['column_name']}: {b['null_rate']:.2%} ({b['null_rows']} of {b['total_rows']})"
            for b in broken
        )
        raise GateFailed(f"null share above {limit:.0%} in {shares}")
    return lines

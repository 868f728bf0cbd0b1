"""Silver names and types, and silver bookkeeping columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline import trips
from tierline.functions.calendar import minutes_between, period_columns, run_time


def standardise(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename to silver names, derive the duration, normalise flag and count.

    The flag is true for ``Y`` alone. A passenger count that is absent or no
    integer becomes 0.
    """
    named = df.withColumnsRenamed(trips.RENAMES if renames is None else renames)
    return named.withColumns(
        {
            "trip_duration_minutes": minutes_between("pickup_datetime", "dropoff_datetime"),
            "store_and_fwd_flag": F.coalesce(F.col("store_and_fwd_flag") == "Y", F.lit(False)),
            "passenger_count": F.coalesce(F.col("passenger_count").try_cast("int"), F.lit(0)),
        }
    )


def with_silver_metadata(
    df: DataFrame, run_ts: datetime | str, version: str = trips.SILVER_VERSION
) -> DataFrame:
    """Add processing time and version, and derive the period keys again."""
    return df.withColumns(
        {
            "_silver_processed_at": run_time(run_ts),
            "_silver_version": F.lit(version),
            **period_columns("pickup_datetime"),
        }
    )

"""Calendar columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.trips import DAY_NAMES


def period_columns(moment: str) -> dict[str, Column]:
    """``_year`` and zero-padded ``_month`` of a timestamp column, as strings."""
    return {
        "_year": F.year(moment).cast("string"),
        "_month": F.lpad(F.month(moment).cast("string"), 2, "0"),
    }


def run_time(moment: datetime | str) -> Column:
    """The time of the run as one literal, equal on every row."""
    return F.lit(moment.isoformat() if isinstance(moment, datetime) else moment).cast("timestamp")


def minutes_between(start: str, end: str) -> Column:
    """Minutes from ``start`` to ``end`` over whole seconds, to two digits."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(60.0), 2)


def day_name(day_number: str) -> Column:
    """English name for a ``dayofweek`` number; NULL reads as the last name."""
    names = F.array(*map(F.lit, DAY_NAMES))
    return F.coalesce(F.try_element_at(names, F.col(day_number)), F.lit(DAY_NAMES[-1]))

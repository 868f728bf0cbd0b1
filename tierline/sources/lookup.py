"""The location lookup and the checks it must pass before it is joined."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import trips

#: A lookup up to these bounds is sent to every executor; see ``LookupFacts``.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


class RepeatedLookupKey(ValueError):
    """The lookup would change the number of trips."""


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup from CSV with a header; a header of other names is an error.

    A location id that is no integer reads as NULL.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .schema(trips.ZONE_SCHEMA)
        .csv(path)
    )


@dataclass(frozen=True)
class LookupFacts:
    """Measured size of a lookup and whether its key repeats."""

    rows: int
    text_bytes: int
    repeated_keys: int

    @property
    def fits_broadcast(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.text_bytes <= BROADCAST_BYTES


def inspect_lookup(lookup: DataFrame, key: str = "LocationID") -> LookupFacts:
    """Measure a lookup in one small job.

    Rows are combined per key first, so the final step adds up counts and never
    holds a group. A NULL key matches no trip and may repeat.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in lookup.columns),
        F.lit(0),
    )
    per_key = lookup.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(width).alias("text_bytes")
    )
    row = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("text_bytes"), F.lit(0)).alias("text_bytes"),
        F.count_if((F.col("n") > 1) & F.col(key).isNotNull()).alias("repeated_keys"),
    ).first()
    return LookupFacts(row["rows"], row["text_bytes"], row["repeated_keys"])


def checked_lookup(lookup: DataFrame, key: str = "LocationID") -> LookupFacts:
    """``inspect_lookup`` that refuses a repeated key, which would multiply trips."""
    facts = inspect_lookup(lookup, key)
    if facts.repeated_keys:
        raise RepeatedLookupKey(f"{facts.repeated_keys} value(s) of {key} occur more than once")
    return facts

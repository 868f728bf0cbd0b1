"""Zone enrichment: the same lookup joined in two roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.sources.lookup import LookupFacts, checked_lookup

def lookup_role(zones: DataFrame, role: str) -> DataFrame:
    """The lookup under the column names of one role (``pickup``, ``dropoff``)."""
    return zones.select(
        F.col("LocationID").alias(f"{role}_location_id"),
        F.col("Borough").alias(f"{role}_borough"),
        F.col("Zone").alias(f"{role}_zone"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )


def join_lookup(df: DataFrame, lookup: DataFrame, key: str, broadcast: bool) -> DataFrame:
    """Left join on ``key`` that keeps every row of ``df``.

    A lookup of proven size is broadcast and ``df`` is not shuffled. A larger one
    is joined by shuffle on the key. Adaptive execution splits the trips of a hot
    location over several tasks and gives each the few lookup rows it needs, which
    a left join allows; nothing is copied beforehand.
    """
    if broadcast:
        return df.join(F.broadcast(lookup), on=key, how="left")
    return df.join(lookup.hint("merge"), on=key, how="left")


def enrich_with_zones(
    df: DataFrame, zones: DataFrame, facts: LookupFacts | None = None
) -> DataFrame:
    """Add borough, zone and service zone of the pickup and of the dropoff.

    ``facts`` are the measured size of ``zones``; without them it is measured
    (and checked for repeated ids) here, in one small job.
    """
    facts = checked_lookup(zones) if facts is None else facts
    for role in ("pickup", "dropoff"):
        df = join_lookup(
            df, lookup_role(zones, role), f"{role}_location_id", facts.fits_broadcast
        )
    return df

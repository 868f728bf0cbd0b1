"""Deduplication with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline import trips


def deduplicate(
    df: DataFrame,
    keys: Sequence[str] = trips.TRIP_KEY,
    prefer: Sequence[str] = ("vendor_id",),
    follows: Sequence[str] = trips.FROM_TRIP_KEY,
    dealt_by: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key: the smallest by ``prefer``, then by all other columns.

    NULL keys are equal to each other and NULLs sort first. Only columns that
    follow from the key (``follows``) stay out of the order, so rows that still
    tie are identical and the result is the same for any partitioning of the
    input. Kept out, those columns need not be shuffled when a later step derives
    them again.

    Catalyst turns ``row_number() == 1`` into a group limit on both sides of the
    shuffle: each map task passes on at most one row per key, so a key that holds
    a large part of the table arrives as one row per map task.

    With ``dealt_by``, columns that follow from the key, the one shuffle brings their
    rows together instead, so that a write by them needs no second one. There is no
    limit before that shuffle; it is meant for as many rows of one value as a task
    can hold.
    """
    settled = {*keys, *prefer, *follows}
    order = [*prefer, *(c for c in df.columns if c not in settled)]
    # 0.0 and -0.0 are one key and two values.
    order += [
        F.when(F.col(c) == 0, F.col(c).cast("string"))
        for c, kind in df.dtypes
        if c in keys and kind in ("double", "float")
    ]
    if dealt_by:
        df = df.repartition(*dealt_by)
    # Rows of a task differ little in ``dealt_by``; sorted by it first, each comparison would
    # go through its values before it meets the key.
    ranked = Window.partitionBy(*keys, *dealt_by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")

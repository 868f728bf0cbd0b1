"""Parquet readers.

Every reader names its schema. Nothing is inferred: an empty table still has
columns, and the period keys stay zero-padded strings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import trips

#: A (year, month) pair as stored, e.g. ``("2024", "02")``; ``(None, None)`` is
#: the partition of rows without a pickup time.
Period = tuple[str | None, str | None]


@dataclass(frozen=True)
class RawInput:
    """A folder of raw files that share one set of column types.

    Parquet cannot read a BIGINT column as INT or as DOUBLE, so files of another
    generation go in as a second ``RawInput`` with the types they were written
    with.
    """

    path: str
    file_schema: T.StructType = trips.RAW_SCHEMA


def conform(df: DataFrame, schema: T.StructType, audit: bool = False) -> DataFrame:
    """Project to exactly ``schema``: drop extra columns, add absent ones as NULL.

    Values outside the target type become NULL. Where the types agree the cast
    disappears from the plan and filters still reach the scan. With ``audit`` further
    columns (``audit_columns``) say which values a cast has changed.
    """
    present = {name.lower(): name for name in df.columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    columns, losses = [], [F.lit(0).cast("bigint") for _ in audit_columns(schema)]
    for place, field in enumerate(schema.fields):
        name = present.get(field.name.lower())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        columns.append(value.try_cast(field.dataType).alias(field.name))
        if audit and name is not None and types[name] != field.dataType:
            chunk, bit = divmod(2 * place, _AUDIT_BITS)
            losses[chunk] = losses[chunk] + _loss(value, types[name], field.dataType, bit)
    if audit:
        columns += [loss.alias(name) for loss, name in zip(losses, audit_columns(schema))]
    return df.select(*columns)


#: Bits of a column that says what casts have lost; two for each column of the schema.
_AUDIT_BITS = 62


def audit_columns(schema: T.StructType) -> list[str]:
    """Names of the columns that ``conform`` adds with ``audit``."""
    return [f"_lost_{k}" for k in range(-(-2 * len(schema.fields) // _AUDIT_BITS))]


def _loss(value: Column, there: T.DataType, wanted: T.DataType, bit: int) -> Column:
    """``2**bit`` where the cast gives NULL, twice that where it gives another value.

    NaN has no counterpart among whole numbers; NULL says the same and is no loss.
    """
    got = value.try_cast(wanted)
    floating = isinstance(there, (T.DoubleType, T.FloatType))
    given = value.isNotNull() & ~F.isnan(value) if floating else value.isNotNull()
    nulled = given & got.isNull()
    changed = got.isNotNull() & ~got.try_cast(there).eqNullSafe(value)
    none = F.lit(0).cast("bigint")
    return F.when(nulled, F.lit(1 << bit).cast("bigint")).otherwise(
        F.when(changed, F.lit(2 << bit).cast("bigint")).otherwise(none)
    )


def audited_fields(inputs: Sequence[RawInput], schema: T.StructType) -> list[str]:
    """Columns that some input has in another type than ``schema``."""
    return [
        f.name
        for f in schema.fields
        for i in inputs
        if any(g.name.lower() == f.name.lower() and g.dataType != f.dataType for g in i.file_schema)
    ]


def loss_counts(fields: Sequence[str], schema: T.StructType) -> list[Column]:
    """Aggregates ``nulled <column>`` and ``changed <column>`` over the audit columns."""
    counts = []
    for name in dict.fromkeys(fields):
        chunk, bit = divmod(2 * schema.names.index(name), _AUDIT_BITS)
        flags = F.col(audit_columns(schema)[chunk])
        for step, kind in enumerate(("nulled", "changed")):
            hit = flags.bitwiseAND(F.lit(1 << (bit + step)).cast("bigint")) != 0
            counts.append(F.count_if(hit).alias(f"{kind} {name}"))
    return counts


def read_raw_trips(
    spark: SparkSession,
    inputs: Sequence[RawInput],
    schema: T.StructType = trips.RAW_SCHEMA,
    audit: bool = False,
) -> DataFrame:
    """Raw trips of all inputs under one schema; ``audit`` as in :func:`conform`."""
    frames = [
        conform(spark.read.schema(i.file_schema).parquet(i.path), schema, audit) for i in inputs
    ]
    return reduce(DataFrame.unionByName, frames)


def in_periods(periods: Sequence[Period]) -> Column:
    """Predicate for the listed periods; on a stored layer it prunes partitions."""

    def matches(name: str, value: str | None) -> Column:
        return F.col(name).isNull() if value is None else F.col(name) == value

    return reduce(
        Column.__or__,
        (matches("_year", year) & matches("_month", month) for year, month in periods),
    )


def read_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    periods: Sequence[Period] | None = None,
) -> DataFrame:
    """A stored layer, whole or for some periods."""
    df = spark.read.schema(schema).parquet(path)
    return df if periods is None else df.filter(in_periods(periods))


def stored_periods(layer: DataFrame) -> list[Period]:
    """The periods of a stored layer; one row per month reaches the driver."""
    rows = layer.select(*trips.PERIOD).distinct().orderBy(*trips.PERIOD).collect()
    return [tuple(row) for row in rows]


def read_bronze(
    spark: SparkSession, path: str, periods: Sequence[Period] | None = None
) -> DataFrame:
    return read_layer(spark, path, trips.BRONZE_SCHEMA, periods)


def read_silver(
    spark: SparkSession, path: str, periods: Sequence[Period] | None = None
) -> DataFrame:
    return read_layer(spark, path, trips.SILVER_SCHEMA, periods)


def read_quarantine(
    spark: SparkSession, path: str, periods: Sequence[Period] | None = None
) -> DataFrame:
    return read_layer(spark, path, trips.QUARANTINE_SCHEMA, periods)


def read_gold(
    spark: SparkSession,
    root: str,
    table: str,
    periods: Sequence[tuple[int | None, int | None]] | None = None,
) -> DataFrame:
    return read_layer(spark, f"{root.rstrip('/')}/{table}", trips.GOLD_TABLES[table], periods)


def schema_drift(
    spark: SparkSession, path: str, expected: T.StructType = trips.RAW_SCHEMA
) -> DataFrame:
    """How the files under ``path`` differ from ``expected``, one row per column.

    ``status`` is ``ok``, ``retyped``, ``missing`` (reads as NULL) or ``extra``
    (not read). Only file footers are looked at. Files that disagree on a type
    among themselves make the merge fail; they belong in separate inputs.
    """
    found = {
        f.name.lower(): f for f in spark.read.option("mergeSchema", True).parquet(path).schema
    }
    rows = []
    for field in expected.fields:
        there = found.pop(field.name.lower(), None)
        if there is None:
            rows.append((field.name, field.dataType.simpleString(), None, "missing"))
        else:
            same = _readable_as(there.dataType) == _readable_as(field.dataType)
            rows.append(
                (
                    field.name,
                    field.dataType.simpleString(),
                    there.dataType.simpleString(),
                    "ok" if same else "retyped",
                )
            )
    rows += [(f.name, None, f.dataType.simpleString(), "extra") for f in found.values()]
    return spark.createDataFrame(
        rows, "column_name string, expected string, found string, status string"
    )


def _readable_as(data_type: T.DataType) -> T.DataType:
    return T.TimestampType() if isinstance(data_type, T.TimestampNTZType) else data_type

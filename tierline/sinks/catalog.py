"""Catalog registration of the gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tierline.sinks.files import Folders, period_folder
from tierline.sources.tables import Period
from tierline.trips import GOLD_TABLES, PERIOD


def register_gold(
    spark: SparkSession,
    root: str,
    database: str | None = None,
    periods: Sequence[Period] | None = None,
) -> list[str]:
    """Declare each gold table over its folder and pick up its periods.

    With ``periods``, only their folders are looked at in a table that was declared
    before; otherwise all are listed.

    Safe to repeat: a table is declared once, new periods are added and vanished
    ones dropped. A table that is declared over another folder is an error, not
    silently left there. A database that does not exist yet is created over ``root``.
    Returns the table names to query.
    """
    root = qualified(spark, root)
    if database is not None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_text(root)}")
    names = []
    for table, schema in GOLD_TABLES.items():
        name = f"`{table}`" if database is None else f"`{database}`.`{table}`"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        location = f"{root.rstrip('/')}/{table}"
        declared = spark.catalog.tableExists(name)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(PERIOD)}) LOCATION {_text(location)}"
        )
        _require_location(spark, name, location)
        # A partition without values has no name in SQL.
        if not declared or periods is None or any(None in p for p in periods):
            spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        else:
            _sync(spark, name, location, periods)
        spark.catalog.refreshTable(name)
        names.append(name)
    return names


def _sync(spark: SparkSession, name: str, location: str, periods: Sequence[Period]) -> None:
    """Add the periods that have a folder, and drop the others."""
    folders = Folders(spark, location)
    there = {p: folders.exists(period_folder(p)) for p in periods}
    for change, wanted in (("ADD IF NOT EXISTS", True), ("DROP IF EXISTS", False)):
        specs = [
            f"PARTITION ({', '.join(f'{k} = {int(v)}' for k, v in zip(PERIOD, p))})"
            for p, found in there.items()
            if found == wanted
        ]
        if specs:
            separator = " " if wanted else ", "
            spark.sql(f"ALTER TABLE {name} {change} {separator.join(specs)}")


def _text(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _require_location(spark: SparkSession, name: str, location: str) -> None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    found = described.filter("col_name = 'Location'").first()["data_type"]

    if qualified(spark, found) != qualified(spark, location):
        raise ValueError(f"{name} is registered over {found}, not over {location}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as the session's file systems resolve it."""
    context = spark.sparkContext
    given = context._jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(context._jsc.hadoopConfiguration())
    return str(system.makeQualified(given)).rstrip("/")

"""A stored record of what runs have finished, and with how many rows.

Each finished step of a run has a folder with a few rows: how many rows a layer has of
each period, and which share of the period's bronze rows that is. A run that is repeated
under the same id goes on after its last finished step.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierline.sinks.files import Folders
from tierline.sources.tables import Period
from tierline.trips import table_schema

LEDGER_SCHEMA = table_schema(
    layer="string", _year="string", _month="string", n_rows="bigint", share="double"
)
#: The columns that the folders add.
STORED_SCHEMA = table_schema(
    layer="string",
    _year="string",
    _month="string",
    n_rows="bigint",
    share="double",
    run="string",
    step="string",
)


@dataclass(frozen=True)
class Entry:
    """Rows of a layer in one period (in all, if that is None)."""

    layer: str
    period: Period | None
    n_rows: int
    share: float | None = None

    def row(self) -> tuple:
        year, month = self.period or (None, None)
        return (self.layer, year, month, self.n_rows, self.share)


@dataclass(frozen=True)
class Ledger:
    """The steps of one run, in the ledger at ``path``."""

    spark: SparkSession
    path: str
    run: str

    def _folder(self, step: str) -> str:
        return f"run={self.run}/step={step}"

    def finished(self, step: str) -> dict[str, int] | None:
        """Rows by layer of a finished step; None where it is not finished."""
        if not Folders(self.spark, self.path).exists(f"{self._folder(step)}/_SUCCESS"):
            return None
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(f"{self.path}/{self._folder(step)}")
        counts: dict[str, int] = {}
        for r in rows.collect():  # a row for each layer and month of the step
            counts[r["layer"]] = counts.get(r["layer"], 0) + r["n_rows"]
        return counts

    def finish(self, step: str, entries: Iterable[Entry]) -> None:
        """Record a step. Spark writes the mark of success last, so a step counts or does not."""
        rows = self.spark.createDataFrame([e.row() for e in entries], LEDGER_SCHEMA)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{self._folder(step)}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All runs: ``run``, ``step``, ``layer``, period, ``n_rows`` and ``share``."""
    return spark.read.schema(STORED_SCHEMA).parquet(path)

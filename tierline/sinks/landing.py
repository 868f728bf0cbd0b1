"""Landing in steps: written beside the table, looked at, and then moved in.

Everything of an input is written once, by period, into a folder beside the table.
What has been found there decides: nothing of the table has changed until the periods
of the run are moved in, each by renaming two folders. The folder that was there before
is kept aside until all periods are in place.

A run that is killed leaves its folder behind. Repeating the run first puts back what
was kept aside and is not in the table, and then starts anew.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tierline.sinks.files import Folders, period_folder
from tierline.sinks.tables import by_period
from tierline.sources.tables import Period, read_layer
from tierline.trips import PERIOD

_NEW, _OLD = "new", "old"


@dataclass(frozen=True)
class Staged:
    """What was written beside ``table``: rows of each period, and what was observed."""

    spark: SparkSession
    table: str
    run: str
    rows: dict[Period, int]
    observed: dict[str, int]

    @property
    def path(self) -> str:
        return f"{_beside(self.table, self.run)}/{_NEW}"

    def read(self, like: DataFrame, periods: Sequence[Period]) -> DataFrame:
        """The staged rows of some periods."""
        return read_layer(self.spark, self.path, like.schema, periods)


def _beside(table: str, run: str) -> str:
    """Folder of a run; it is on the file system of the table, but not inside of it."""
    return f"{table.rstrip('/')}.landing/{run}"


def stage(
    df: DataFrame,
    table: str,
    run: str,
    observe: Sequence[Column] = (),
    hidden: Sequence[str] = (),
    rebalance: bool = False,
) -> Staged:
    """Write ``df`` beside ``table``, replacing what an earlier try of ``run`` left there.

    ``observe`` are named aggregates over the written rows, taken in the stage that
    writes, so a row is counted once also where tasks run again; ``hidden`` columns are
    there for them and not written.
    """
    spark = df.sparkSession
    put_back(spark, table, run)
    seen = Observation()
    counted = (by_period(df) if rebalance else df).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), *observe
    )
    kept = counted.drop(*hidden)
    (
        kept.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*PERIOD)
        .parquet(f"{_beside(table, run)}/{_NEW}")
    )
    observed = {name: value or 0 for name, value in seen.get.items() if name != "n_rows"}
    found = read_layer(spark, f"{_beside(table, run)}/{_NEW}", kept.schema)
    return Staged(spark, table, run, rows_by_period(found), observed)


def rows_by_period(layer: DataFrame) -> dict[Period, int]:
    """Rows of each stored period, from the file footers; a row for each month is collected."""
    counts = layer.groupBy(*PERIOD).agg(F.count(F.lit(1)).alias("n")).collect()
    return {(row[0], row[1]): row[2] for row in counts}


def put_back(spark: SparkSession, table: str, run: str) -> None:
    """Undo what a killed run left half done."""
    folders, name, beside = _around(spark, table, run)
    for period in folders.periods(f"{beside}/{_OLD}"):
        if not folders.exists(f"{name}/{period}"):
            folders.move(f"{beside}/{_OLD}/{period}", f"{name}/{period}")
    folders.delete(beside)


def _around(spark: SparkSession, table: str, run: str) -> tuple[Folders, str, str]:
    """The folder that holds the table, and in it the names of the table and of the run's folder."""
    parent, slash, name = table.rstrip("/").rpartition("/")
    return Folders(spark, parent or slash or "."), name, f"{name}.landing/{run}"


def move_in(staged: Staged, periods: Iterable[Period]) -> int:
    """Put the staged periods in place of those of the table; returns rows moved.

    A period without staged rows is emptied.
    """
    return move_in_together([(staged, periods)])[0]


def move_in_together(tables: Sequence[tuple[Staged, Iterable[Period]]]) -> list[int]:
    """``move_in`` of several tables: all of them have their new periods, or none.

    Every table has been written when the first folder is renamed. A rename that fails
    turns back those before it; after a kill between two of them a repeat of the run does.
    """
    begun: list[tuple[Staged, list[Period]]] = []
    try:
        for staged, periods in tables:
            begun.append((staged, list(periods)))
            _swap(*begun[-1])
    except BaseException:
        for staged, periods in reversed(begun):
            _swap_back(staged, periods)
        raise
    for staged, _ in begun:
        discard(staged)
    return [sum(staged.rows.get(p, 0) for p in periods) for staged, periods in begun]


def _swap(staged: Staged, periods: Iterable[Period]) -> None:
    folders, name, beside = _around(staged.spark, staged.table, staged.run)
    folders.make(name)
    for folder in map(period_folder, periods):
        if folders.exists(f"{name}/{folder}"):
            folders.move(f"{name}/{folder}", f"{beside}/{_OLD}/{folder}")
        if folders.exists(f"{beside}/{_NEW}/{folder}"):
            folders.move(f"{beside}/{_NEW}/{folder}", f"{name}/{folder}")


def _swap_back(staged: Staged, periods: Iterable[Period]) -> None:
    folders, name, beside = _around(staged.spark, staged.table, staged.run)
    for period in periods:
        folder = period_folder(period)
        moved_in = staged.rows.get(period) and not folders.exists(f"{beside}/{_NEW}/{folder}")
        if moved_in and folders.exists(f"{name}/{folder}"):
            folders.move(f"{name}/{folder}", f"{beside}/{_NEW}/{folder}")
        if folders.exists(f"{beside}/{_OLD}/{folder}"):
            folders.move(f"{beside}/{_OLD}/{folder}", f"{name}/{folder}")


def write_strays(staged: Staged, like: DataFrame, strays: str, periods: Sequence[Period]) -> int:
    """The staged rows of other periods in a folder of this run, which a repeat replaces.

    Below ``strays`` each run has its own folder ``run=<run>``; one without strays has
    none. The folders of those periods are moved there; on another file system they are
    written again, and only their files are read.
    """
    others = [p for p in staged.rows if p not in set(periods)]
    target = f"{strays.rstrip('/')}/run={staged.run}"
    folders, _, beside = _around(staged.spark, staged.table, staged.run)
    if not others or folders.holds(strays):
        Folders(staged.spark, strays).delete(f"run={staged.run}")
        for folder in map(period_folder, others):
            folders.move_out(f"{beside}/{_NEW}/{folder}", f"{target}/{folder}")
    else:
        (
            staged.read(like, others)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*PERIOD)
            .parquet(target)
        )
    return sum(staged.rows[p] for p in others)


def discard(staged: Staged) -> None:
    """Drop what was staged; the table is as it was."""
    folders, _, beside = _around(staged.spark, staged.table, staged.run)
    folders.delete(beside)

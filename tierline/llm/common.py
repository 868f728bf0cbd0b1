"""What several operators of this package need."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.session import work_folder

#: ASCII white space, the separator of words.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, ``[^\\x20\\x09-\\x0D]+``; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+")
    # Only the first and the last part can be empty.
    return F.filter(parts, lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    """How many words a text has, as long; 0 for null."""
    inner = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^[{SPACE}]+|[{SPACE}]+\z", "")
    parts = F.size(F.split(inner, f"[{SPACE}]+"))
    return F.when(inner == F.lit(""), F.lit(0)).otherwise(parts).cast("long")


def one_space(text: Column) -> Column:
    """Each run of white space as one space; null as empty.

    The pattern leaves single spaces alone, so most of a text is copied as it is.
    """
    runs = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` evaluated once however often body names it.

    A column defined in an earlier ``select`` does not promise that: predicates are
    pushed below it with its definition put in their place, also inside lambdas.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(rows: DataFrame, columns: list[Column], values: Column) -> DataFrame:
    """``columns`` and the fields of the struct ``values``, computed once for each row.

    A generator keeps later filters on the fields from computing them again.
    """
    return rows.select(*columns, F.inline_outer(F.array(values)))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whatever their Python path; once a session.

    The archive lies with the driver, from which Spark hands it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    name = Path(tempfile.mkdtemp(prefix="tierline-")) / "tierline.zip"
    with zipfile.ZipFile(name, "w") as archive:
        for path in sorted((top / "tierline").rglob("*.py")):
            archive.write(path, path.relative_to(top))
    context.addPyFile(str(name))
    _shipped.add(context.applicationId)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing from {df.columns}")


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters that has."""
    return F.col("`" + re.sub("`", "``", name) + "`")

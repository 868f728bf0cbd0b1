"""What the files of a folder say about their columns, file by file.

The footers are read in tasks and nothing is merged, so files that disagree are found
and named before a value of theirs is read with a wrong type.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.tables import RawInput

#: How file systems of Hadoop are called by the reader of the footers.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs", "gcs": "gs"}

_COLUMNS = "file string, column_name string, type string, n_rows bigint"

#: Types that Spark reads as a wider one without loss: (in the file, asked for).
_WIDENED = (
    ("tinyint", "int"),
    ("smallint", "int"),
    ("int", "bigint"),
    ("int", "double"),
    ("float", "double"),
    ("timestamp_ntz", "timestamp"),
    ("timestamp", "timestamp_ntz"),
)


#: Files that are looked at without a job of their own.
FEW = 64


class SchemaDisagreement(ValueError):
    """Files of an input have columns of types that its schema cannot read."""


def file_columns(spark: SparkSession, path: str) -> DataFrame:
    """A row for each column of each file: ``file``, ``column_name``, ``type``, ``n_rows``.

    Types are named as in Spark. Files are listed by Spark and dealt to tasks, which
    read footers only; up to ``FEW`` files are looked at here, which is quicker than
    to begin Python on the executors. On file systems that the reader of footers doesn't
    know, Spark reads the files.
    """
    few = _few(spark, path)
    if few is not None:
        return spark.createDataFrame(few, _COLUMNS)
    files = spark.read.format("binaryFile").load(path)
    first = files.select("path").first()["path"]
    known = first.split(":", 1)[0] in _SCHEMES
    listed = files.select("path", F.lit(None).cast("binary") if known else "content")
    return listed.mapInArrow(_footers, _COLUMNS)


def _few(spark: SparkSession, path: str) -> list[tuple] | None:
    """The rows of :func:`file_columns` where there are few files, else None."""
    files = spark.read.format("binaryFile").load(path).select("path")
    some = [r["path"] for r in files.limit(FEW + 1).collect()]
    if len(some) > FEW or any(p.split(":", 1)[0] not in _SCHEMES for p in some):
        return None
    nothing = pa.nulls(len(some), pa.binary())
    batch = pa.RecordBatch.from_arrays([pa.array(some, pa.string()), nothing], ["path", "content"])
    return [tuple(r.values()) for b in _footers(iter([batch])) for r in b.to_pylist()]


def schema_census(spark: SparkSession, path: str) -> DataFrame:
    """How many files and rows have each column with each type, and one such file.

    Names are told apart as Spark does, without regard to case; a file without a column
    is missing from that column's counts.
    """
    return (
        file_columns(spark, path)
        .groupBy(F.lower("column_name").alias("name"), "type")
        .agg(
            F.min("column_name").alias("column_name"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("n_rows").alias("n_rows"),
            F.min("file").alias("a_file"),
        )
        .select("column_name", "type", "n_files", "n_rows", "a_file")
    )


def unreadable(census: DataFrame, expected: T.StructType) -> DataFrame:
    """The lines of a census whose type cannot be read as ``expected`` has it."""
    wrong = F.lit(False)
    for field in expected.fields:
        named = F.lower("column_name") == field.name.lower()
        wrong = wrong | (named & ~F.col("type").isin(_read_as(field)))
    return census.filter(wrong)


def _read_as(field: T.StructField) -> list[str]:
    """Types in files that a column can be read from."""
    asked = field.dataType.simpleString()
    return [asked, *(there for there, wanted in _WIDENED if wanted == asked)]


def check_files(spark: SparkSession, source: RawInput) -> None:
    """Raise ``SchemaDisagreement`` if any file of the input would be misread.

    A line for each wrong column and type reaches the driver.
    """
    fields = {f.name.lower(): f for f in source.file_schema.fields}
    few = _few(spark, source.path)
    if few is not None:
        wrong: dict[tuple[str, str], list[str]] = {}
        for file, name, kind, _ in few:
            field = fields.get(name.lower())
            if field is not None and kind not in _read_as(field):
                wrong.setdefault((field.name, kind), []).append(file)
        lines = [(name, kind, len(files), min(files)) for (name, kind), files in wrong.items()]
    else:
        found = unreadable(schema_census(spark, source.path), source.file_schema).collect()
        lines = [(fields[r["column_name"].lower()].name, r["type"], r["n_files"], r["a_file"]) for r in found]
    if lines:
        said = "; ".join(
            f"{name} is {kind} and not {fields[name.lower()].dataType.simpleString()} in "
            f"{n} file(s), such as {file}"
            for name, kind, n, file in sorted(lines)
        )
        raise SchemaDisagreement(f"{source.path}: {said}")


# --- in tasks --------------------------------------------------------------


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            with _opened(path, content) as source:
                footer = pyarrow.parquet.read_metadata(source)
            old = _old_timestamps(footer)
            rows += [
                (path, field.name, "timestamp" if field.name in old else type_name(field.type), footer.num_rows)
                for field in footer.schema.to_arrow_schema()
            ]
        names = [c.split()[0] for c in _COLUMNS.split(", ")]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        columns = zip(*rows) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _opened(path: str, content: pa.Scalar):
    if content.is_valid:
        return io.BytesIO(content.as_py())
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pa.OSFile("/" + rest.lstrip("/"))
    system, inside = pyarrow.fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:{quote(rest)}")
    return system.open_input_file(inside)


def _old_timestamps(footer) -> set[str]:
    """Top-level columns in the older form of timestamps."""
    columns = (footer.schema.column(i) for i in range(len(footer.schema)))
    return {c.path for c in columns if c.physical_type == "INT96"}


def type_name(kind: pa.DataType) -> str:
    """The name that Spark has for an Arrow type; others keep theirs."""
    plain = {
        pa.bool_(): "boolean",
        pa.int8(): "tinyint",
        pa.int16(): "smallint",
        pa.int32(): "int",
        pa.int64(): "bigint",
        pa.float32(): "float",
        pa.float64(): "double",
        pa.string(): "string",
        pa.binary(): "binary",
        pa.date32(): "date",
    }
    if pa.types.is_timestamp(kind):
        return "timestamp_ntz" if kind.tz is None else "timestamp"
    if pa.types.is_decimal(kind):
        return f"decimal({kind.precision},{kind.scale})"
    return plain.get(kind, str(kind))

"""Session settings the results depend on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


#: How layers are written. Taken only where the session says nothing else.
#: * Timestamps as micros keep statistics in the files, the older form does not.
#: * A task that meets few periods writes them side by side instead of sorting
#:   its rows by period first; with more of them it falls back to the sort.
#: * A task reads little enough that a sort of its rows, many times the size of
#:   the file, stays in memory.
#: * Files are packed more tightly.
_WRITING = {
    "spark.sql.parquet.outputTimestampType": ("INT96", "TIMESTAMP_MICROS"),
    "spark.sql.maxConcurrentOutputFileWriters": ("0", "32"),
    "spark.sql.files.maxPartitionBytes": ("134217728b", "33554432b"),
    "spark.sql.parquet.compression.codec": ("snappy", "zstd"),
}


#: Folder of a local application that names no shared one.
_LOCAL_FOLDERS: dict[str, str] = {}


def pin_session(spark: SparkSession) -> SparkSession:
    """Fix what the results depend on, and set how layers are written.

    Calendar columns are taken in UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name, (default, ours) in _WRITING.items():
        if spark.conf.get(name) == default:
            spark.conf.set(name, ours)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder of the cluster.

    That is the folder named by ``spark.checkpoint.dir``. Only a local session
    without one gets a folder under the machine's temporary directory, which
    other machines would not see.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tierline-")
        shared = _LOCAL_FOLDERS[application]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

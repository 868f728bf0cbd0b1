"""Web archives: written as one gzip member per record, read back in splits.

Writing: payloads that occur twice or more are found by their digests; the row
with the smallest id is written as a response, the others as revisits to it.
Each task writes archives of its own to the shared folder, under names no other
attempt uses. Which files count is in a table that Spark commits, so the files of
lost or repeated attempts are never read.

Reading: a task gets a byte range of a file. It looks for the gzip magic bytes,
decodes the header of each candidate to see whether a record begins there, and
then owns every record that starts inside its range, reading past the end of the
range for the last one. Nothing but (file, range) is known before.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm.common import quoted, require_columns, stored
from tierline.session import work_folder

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"\x1f\x8b\x08"

#: The files of a write; of each stretch of ``window`` bytes how many records begin in it.
ARCHIVES = "path string, size long, records long, window long, starts array<long>"
RECORDS = (
    "path string, position long, record_id string, record_type string, uri string, "
    "refers_to string, payload_bytes long, payload_digest string, payload binary"
)

#: Salts of a digest, so that one payload of a third of all pages is spread.
SALTS = 16


@dataclass(frozen=True)
class Archives:
    """Parameters of writing and reading.

    Payloads shorter than ``least_bytes`` are always written as responses. A task
    begins another file beyond ``file_bytes``.
    """

    least_bytes: int = 100
    file_bytes: int = 1 << 30
    split_bytes: int = 64 << 20
    date: str = "2024-01-01T00:00:00Z"
    level: int = 6


def write_archives(
    pages: DataFrame,
    folder: str,
    params: Archives = Archives(),
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
) -> DataFrame:
    """Write a record per row below ``folder``; the table of files that hold them.

    * A null payload is empty. A null id stays null and comes after all others;
      a null url leaves out the target header.
    * Rows that repeat the id of a response are responses too.
    * An empty table gives no file or files without records.
    """
    require_columns(pages, id_column, url_column, payload_column)
    payload = F.coalesce(quoted(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        quoted(id_column).cast("string").alias("id"),
        quoted(id_column).alias("rank"),
        quoted(url_column).cast("string").alias("url"),
        F.sha2(payload, 256).alias("digest"),
        payload.alias("payload"),
    ).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    found = rows.join(_first_of_equals(rows, params), ["digest", "salt"], "left")
    # Only a payload that goes to a response travels on to Python.
    again = F.col("first").isNotNull() & ~F.col("rank").eqNullSafe(F.col("first"))
    records = found.select(
        "id",
        "url",
        "digest",
        F.when(again, F.col("first").cast("string")).alias("refers_to"),
        again.alias("revisit"),
        F.octet_length("payload").cast("long").alias("size"),
        F.when(~again, F.col("payload")).alias("payload"),
    )
    written = records.mapInArrow(lambda b: _write(b, folder, params), ARCHIVES)
    return stored(written, "warc-files")


def _first_of_equals(rows: DataFrame, params: Archives) -> DataFrame:
    """Smallest id of each payload that occurs again, for every salt."""
    long_enough = F.octet_length("payload") >= params.least_bytes
    groups = (
        rows.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return groups.select("digest", "first", salts)


def read_archives(
    archives: DataFrame, params: Archives = Archives(), payloads: bool = True
) -> DataFrame:
    """A row per record of the files in ``archives`` (columns path and size).

    Columns as in ``RECORDS``. Digest and size are those of the bytes found; of a
    revisit, which has no payload, those that its headers give. Without
    ``payloads`` that column is null and no payload is held in memory.

    * Bytes between records that are no record are skipped.
    * A record that breaks off, or whose check sum is wrong, raises an error. So does a
      split in which other than the records begin that were written, where ``archives``
      says how many (as ``write_archives`` does) for splits of this size.
    * Without files the result is empty.
    """
    step = params.split_bytes
    written = {"window", "starts"} <= set(archives.columns)
    starts = F.when(F.col("window") == step, F.col("starts")) if written else F.lit(None)
    splits = archives.filter("size > 0").select(
        "path",
        F.posexplode(
            F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(step).cast("long"))
        ).alias("split", "low"),
        starts.cast("array<long>").alias("starts"),
    )
    splits = splits.select("path", "low", F.get("starts", F.col("split")).alias("expected"))
    count = archives.agg(F.sum(F.ceil(F.col("size") / step))).first()[0] or 1
    # Round robin over as many tasks as there are splits; rows of a few bytes
    # would otherwise be put together.
    dealt = splits.repartition(int(min(count, 100_000)))
    return dealt.mapInArrow(lambda b: _read(b, step, payloads), RECORDS)


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and size of the archives below a folder, for files written elsewhere."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.warc.gz")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )
    return found.select("path", F.col("length").alias("size"))


def archive_folder(spark: SparkSession) -> str:
    return work_folder(spark, "warc")


# --- writing ---------------------------------------------------------------


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, params: Archives
) -> Iterator[pa.RecordBatch]:
    system, root = fs.FileSystem.from_uri(folder if "://" in folder or ":/" in folder else f"file://{folder}")
    system.create_dir(root, recursive=True)
    out, done, name, starts = None, [], "", []

    def close() -> None:
        size = out.tell()
        starts.extend([0] * (-(-size // params.split_bytes) - len(starts)))
        done.append((name, size, starts))
        out.close()

    for batch in batches:
        for row in _rows(batch):
            if out is None:
                name = f"{root}/part-{uuid.uuid4().hex}.warc.gz"
                out, starts = system.open_output_stream(name, compression=None), []
            window = out.tell() // params.split_bytes
            starts.extend([0] * (window + 1 - len(starts)))
            starts[window] += 1
            out.write(_member(_record(row, params), params.level))
            if out.tell() >= params.file_bytes:
                close()
                out = None
    if out is not None:
        close()
    scheme = "file://" if isinstance(system, fs.LocalFileSystem) else folder[: folder.find(root)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([scheme + d[0] for d in done], pa.string()),
            pa.array([d[1] for d in done], pa.int64()),
            pa.array([sum(d[2]) for d in done], pa.int64()),
            pa.array([params.split_bytes] * len(done), pa.int64()),
            pa.array([d[2] for d in done], pa.list_(pa.int64())),
        ],
        ["path", "size", "records", "window", "starts"],
    )


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row, so that one payload at a time is copied."""
    names = batch.schema.names
    for i in range(batch.num_rows):
        yield {name: batch.column(k)[i].as_py() for k, name in enumerate(names)}


def _record(row: dict, params: Archives) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['size']}\r\n\r\n"
    ).encode()
    block = http + (row["payload"] or b"")
    headers = [
        ("WARC-Type", "revisit" if row["revisit"] else "response"),
        ("WARC-Record-ID", _urn(row["id"])),
        ("WARC-Date", params.date),
        ("WARC-Target-URI", _one_line(row["url"])),
        ("WARC-Payload-Digest", f"sha256:{row['digest']}"),
        ("WARC-Profile", REVISIT_PROFILE if row["revisit"] else None),
        ("WARC-Refers-To", _urn(row["refers_to"]) if row["revisit"] else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _urn(ident: str | None) -> str:
    return f"<urn:page:{_one_line(ident) if ident is not None else ''}>"


def _one_line(value: str | None) -> str | None:
    """Control characters and white space percent-encoded: headers end at a line end."""
    if value is None:
        return None
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# --- reading ---------------------------------------------------------------

_BLOCK = 1 << 18


def _read(
    batches: Iterator[pa.RecordBatch], step: int, payloads: bool
) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in RECORDS.split(", ")]
    types = [pa.string(), pa.int64()] + [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]

    def out(rows):
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names
        )

    for batch in batches:
        for row in _rows(batch):
            rows, held, found = [], 0, 0
            for record in records_in(row["path"], row["low"], row["low"] + step, payloads):
                found += 1
                rows.append((row["path"], *record))
                held += len(record[-1] or b"") + 200
                if held >= 1 << 24:
                    yield out(rows)
                    rows, held = [], 0
            yield out(rows)
            if row["expected"] is not None and found != row["expected"]:
                raise ValueError(
                    f"{found} records begin in the split at byte {row['low']} of {row['path']}, "
                    f"where {row['expected']} were written"
                )


def records_in(path: str, low: int, high: int, payloads: bool) -> Iterator[tuple]:
    """The records of a file that start in [low, high)."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        size = file.size()
        at = low
        while (at := _next_record(file, at, min(high, size), size)) is not None:
            # From a record on, the next one mostly follows directly.
            while at < min(high, size) and _begins_record(file, at):
                record, after = _decode(file, at, payloads)
                yield (at, *record)
                at = after


def _next_record(file, low: int, high: int, size: int) -> int | None:
    """The first place in [low, high) where a record begins."""
    at = low
    while at < high:
        data = file.read_at(min(_BLOCK + len(MAGIC) - 1, size - at), at)
        found = data.find(MAGIC)
        while found >= 0 and at + found < high:
            if _begins_record(file, at + found):
                return at + found
            found = data.find(MAGIC, found + 1)
        at += _BLOCK
    return None


def _begins_record(file, at: int) -> bool:
    """Whether a gzip member begins here and opens with a whole record header."""
    head = _head(file, at, 1 << 12)
    if head is None:
        # An error in a piece hides what came before it in that piece.
        head = _head(file, at, 1)
    if head is None or not head.startswith(VERSION[:7]) or b"\r\n\r\n" not in head:
        return False
    fields = _fields(head)
    return "warc-type" in fields and fields.get("content-length", "").isdigit()


def _head(file, at: int, piece: int) -> bytes | None:
    """The member's beginning up to an empty line, or what there is of it; None on an error.

    A header has any length; what does not open like a record is given up at once.
    """
    unpacker, head = zlib.decompressobj(31), bytearray()
    for data in _blocks(file, at, 1 << 12):
        for low in range(0, len(data), piece):
            packed = data[low : low + piece]
            while packed and not unpacker.eof:
                try:
                    plain = unpacker.decompress(packed, 1 << 20)
                except zlib.error:
                    return None
                packed = unpacker.unconsumed_tail
                before = max(len(head) - 3, 0)
                head += plain
                if head.find(b"\r\n\r\n", before) >= 0 or not head.startswith(VERSION[: min(len(head), 7)]):
                    return bytes(head)
            if unpacker.eof:
                return bytes(head)
    return bytes(head)


def _blocks(file, at: int, block: int) -> Iterator[bytes]:
    while data := file.read_at(block, at):
        yield data
        at += len(data)
        block = min(2 * block, _BLOCK)


def _fields(head: bytes) -> dict[str, str]:
    lines = head[: head.index(b"\r\n\r\n")].decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.partition(":") for line in lines)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _decode(file, at: int, payloads: bool) -> tuple[tuple, int]:
    """The record whose member begins at ``at``, and where the member ends.

    The payload is digested as it is decoded. zlib checks the member's sum.
    """
    unpacker, start = zlib.decompressobj(31), at
    head, fields, http, left = b"", None, b"", 0
    digest, seen, kept = hashlib.sha256(), 0, bytearray()

    def take(data: bytes) -> None:
        nonlocal seen
        digest.update(data)
        seen += len(data)
        if payloads:
            kept.extend(data)

    in_payload = False
    for data in _blocks(file, at, 1 << 14):
        plain = unpacker.decompress(data)
        at += len(data) - len(unpacker.unused_data)
        if fields is None:
            head += plain
            if b"\r\n\r\n" not in head:
                plain = b""
            else:
                fields = _fields(head)
                left = int(fields["content-length"])
                plain = head[head.index(b"\r\n\r\n") + 4 :]
        if fields is not None:
            plain, left = plain[:left], left - min(left, len(plain))
            if in_payload:
                take(plain)
            else:
                http += plain
                if b"\r\n\r\n" in http:
                    in_payload = True
                    cut = http.index(b"\r\n\r\n") + 4
                    take(http[cut:])
                    http = http[:cut]
        if unpacker.eof:
            break
    if not unpacker.eof or fields is None or left:
        raise ValueError(f"the record at byte {start} breaks off")
    kind = fields["warc-type"]
    stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "revisit":
        size = int(_fields(http).get("content-length", 0))
        found, payload = stated, None
    else:
        size, found, payload = seen, digest.hexdigest(), bytes(kept) if payloads else None
        if stated and stated != found:
            raise ValueError(f"the payload of the record at byte {start} has another digest")
    record = (
        _from_urn(fields.get("warc-record-id")),
        kind,
        fields.get("warc-target-uri"),
        _from_urn(fields.get("warc-refers-to")),
        size,
        found,
        payload,
    )
    return record, at


def _from_urn(value: str | None) -> str | None:
    if value is None:
        return None
    return value.removeprefix("<urn:page:").removesuffix(">") or None

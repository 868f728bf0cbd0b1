"""Repeated byte strings, by a radix sort of suffixes that stops at a given depth.

Only strings of ``length`` bytes count, so suffixes need to be ordered no further
than that: a most-significant-digit sort whose groups, after the last digit, are
exactly the repeated windows. The digits are taken so that most suffixes leave in
the first pass and equal ones stay together as long as possible:

1. A window's first digit is its *anchor*: of its 200-byte grams the one with the
   smallest hash. Equal windows have equal anchors at equal places. The windows
   of a text that have one anchor follow each other, so a digit is kept for such
   a *run* of windows (about a hundred) and not for each.
2. Runs whose anchor occurs nowhere else leave. The next digit of those that stay
   is the whole string a run covers; equal runs are repeated in all their windows.
3. Where an anchor has different runs, at the ends of a repeat, one run of each
   kind is taken apart into its windows, and the whole window is the last digit.

A digit is a hash of its bytes, taken together with the digit before. Equal rows
of a task are combined before each pass, so a passage of a third of all documents
is no hot spot. In a pass equal digits meet by sorting; a row is compared with
its neighbours only, and no group is held in memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored
from tierline.llm.line_hashing import merged, table_batch, without

_PLACE_BITS = 22
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
#: Window starts that are worked on at once; with the bytes behind, below 2^22.
_SLICE = 1 << 20
#: Bytes of text whose rows a task holds at once.
_PORTION = 1 << 22

#: What a text loses: spans are byte ranges of the original, in order.
SPANS = (
    "doc long, version long, n_removed long, span_starts array<long>, span_ends array<long>, "
    "kept_sha256 string, kept binary"
)

#: Rows on their way to be sorted: alone among their task's, standing for several
#: equal ones, or known to be repeated.
_ALONE, _SEVERAL, _KNOWN = 0, 1, 2


@dataclass(frozen=True)
class Repeats:
    """Parameters, in bytes; ``gram`` is at least 1 and less than ``length``."""

    length: int = 400
    gram: int = 200

    def __post_init__(self):
        if not 1 <= self.gram < self.length <= 1 << 20:
            raise ValueError("gram must be below length, and length at most 2**20")


def drop_repeats(
    docs: DataFrame,
    params: Repeats = Repeats(),
    id_column: str = "doc_id",
    text_column: str = "text",
    texts: bool = False,
) -> DataFrame:
    """A row per row of ``docs``: what is removed, and what is left.

    A byte is removed if a string of ``length`` bytes covers it that also begins
    anywhere else, in the same text or another. Strings lie within one text, and
    all are judged on the input. Columns: the id, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``span_starts``, ``span_ends`` (byte ranges of the original),
    ``kept_sha256``, ``kept_text`` (binary; null without ``texts``).

    * A null text is empty. Texts shorter than ``length`` stay as they are.
    * Rows that repeat id and text are copies of each other. Different texts that share
      an id, or have none, are documents of their own.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    text = F.coalesce(quoted(text_column), F.lit(""))
    rows = docs.select(
        quoted(id_column).alias("id"),
        F.coalesce(quoted(id_column).cast("long"), F.xxhash64(text)).alias("doc"),
        F.xxhash64(text).alias("version"),
        text.cast("binary").alias("text"),
    )
    spans = _spans(rows.select("doc", "version", "text"), params, texts)
    whole = rows.select(
        "id",
        F.col("doc").alias("own"),
        F.col("version").alias("own_version"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("sha256"),
        (F.col("text") if texts else F.lit(None).cast("binary")).alias("text"),
    )
    same = (F.col("own") == F.col("doc")) & (F.col("own_version") == F.col("version"))
    found = whole.join(spans, same, "left")
    none = F.array().cast("array<long>")
    return found.select(
        F.col("id").alias(id_column),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("span_starts"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("span_starts", none).alias("span_starts"),
        F.coalesce("span_ends", none).alias("span_ends"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        F.coalesce("kept", "text").alias("kept_text"),
    )


def _spans(rows: DataFrame, params: Repeats, texts: bool) -> DataFrame:
    """Spans of the documents that lose anything; one row for each."""
    runs = rows.mapInArrow(
        lambda b: _run_rows(b, params),
        "anchor long, whole long, doc long, version long, start long, count int, kind int",
    )
    # Rows of one anchor meet sorted by run, and are passed on one after another.
    kinds = (
        runs.repartition("anchor")
        .sortWithinPartitions("anchor", "whole", "kind")
        .mapInArrow(_compare_runs, "doc long, version long, run long")
    )
    key = ["doc", "version"]
    by_doc = stored(kinds, "repeat-runs").groupBy(*key).agg(F.collect_list("run").alias("runs"))
    touched = stored(rows.join(by_doc, key), "repeat-texts")
    windows = touched.mapInArrow(
        lambda b: _window_rows(b, params),
        "window long, anchor int, doc long, version long, start long, kind int",
    )
    again = (
        windows.repartition("window")
        .sortWithinPartitions("window", "anchor", "kind")
        .mapInArrow(_compare_windows, "doc long, version long, start long")
    )
    starts = stored(again, "repeat-windows").groupBy(*key).agg(
        F.collect_list("start").alias("starts")
    )
    joined = touched.join(starts, key, "left").select(*key, "text", "runs", "starts")
    removed = joined.mapInArrow(lambda b: _removed(b, params.length, texts), SPANS)
    # Rows that repeat an id and a text have the same spans.
    return removed.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in ("n_removed", "span_starts", "span_ends", "kept_sha256", "kept")]
    )


class Hashes:
    """Hashes of substrings of one buffer, from sums over its beginnings."""

    def __init__(self, data: np.ndarray):
        self._up, self._down = _powers(_capacity(len(data) + 1))
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self._up[: len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return arrays.mixed((self._sums[start + length] - self._sums[start]) * self._down[start])

    def all(self, length: int) -> np.ndarray:
        """Of the strings of one length at every place; none in a shorter buffer."""
        n = max(len(self._sums) - length, 0)
        return arrays.mixed((self._sums[length:] - self._sums[:n]) * self._down[:n])


#: A number for each byte value, at least 1 apart in all bits.
_BYTES = arrays.mixed(np.arange(1, 257, dtype=np.uint64))


def _capacity(n: int) -> int:
    return max(1 << 16, 1 << (n - 1).bit_length())


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    return arrays.powers(n), arrays.powers(n, np.uint64(pow(base, -1, 1 << 64)))


def runs_of(data: np.ndarray, offsets: np.ndarray, params: Repeats) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor, in all rows of a buffer.

    ``row``, ``start`` and ``count`` (of windows, from the row's beginning),
    ``anchor`` (hash) and ``whole`` (hash of all that the run covers).
    """
    found = []
    for low, high, rows in _slices(offsets, params.length):
        part = data[low:high]
        hashes = Hashes(part)
        gram = hashes.all(params.gram)
        key = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
        anchors = (_sliding_min(key, params.length - params.gram + 1) & _PLACE).astype(np.int64)
        starts, row = _window_starts(offsets, rows, low, high, params.length)
        if not len(starts):
            continue
        at = anchors[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        start = starts[first]
        covered = count - 1 + params.length
        whole = arrays.mixed(hashes.of(start, covered) + covered.astype(np.uint64))
        found.append((row[first], start + low - offsets[row[first]], count, gram[at[first]], whole))
    names = ("row", "start", "count", "anchor", "whole")
    kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
    return {
        name: np.concatenate([f[i] for f in found]) if found else np.empty(0, kind)
        for i, (name, kind) in enumerate(zip(names, kinds))
    }


def _slices(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, tuple[int, int]]]:
    """Byte ranges with the rows they touch; each window lies in the one it begins in."""
    total, low = int(offsets[-1]), 0
    while low < total:
        high = min(low + _SLICE, total)
        rows = (
            int(np.searchsorted(offsets, low, side="right")) - 1,
            int(np.searchsorted(offsets, high, side="left")),
        )
        yield low, min(high + length - 1, total), rows
        low = high


def _window_starts(offsets, rows, low, high, length) -> tuple[np.ndarray, np.ndarray]:
    """Places of the slice where a window of one row begins, and those rows."""
    first, last = rows
    begins = np.maximum(offsets[first:last], low)
    ends = np.minimum(offsets[first + 1 : last + 1] - length + 1, min(low + _SLICE, high - length + 1))
    n = np.maximum(ends - begins, 0)
    row = np.repeat(np.arange(first, last), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return within + np.repeat(begins, n) - low, row


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:]) if len(values) > size else values[:0]
        size *= 2
    if size < width:
        rest = width - size
        values = np.minimum(values[:-rest], values[rest:]) if len(values) > rest else values[:0]
    return values


# --- in tasks --------------------------------------------------------------


def _combined(keys: list[np.ndarray]) -> np.ndarray:
    """Kinds of rows by their keys: alone, first of several equal ones, or another of them."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return np.empty(0, dtype=np.int32)
    same = np.ones(len(order) - 1, dtype=bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    before = np.concatenate(([False], same))
    after = np.concatenate((same, [False]))
    kind = np.full(len(order), _ALONE, dtype=np.int32)
    kind[order[after & ~before]] = _SEVERAL
    kind[order[before]] = _KNOWN
    return kind


def _run_rows(batches: Iterator[pa.RecordBatch], params: Repeats) -> Iterator[pa.RecordBatch]:
    """Runs of windows; of equal ones in a portion one goes on for all."""
    for batch in arrays.portions(batches, 2, _PORTION):
        r = runs_of(*arrays.texts_of(batch.column(2)), params)
        docs, versions = (batch.column(k).to_numpy()[r["row"]] for k in range(2))
        kind = _combined([r["anchor"], r["whole"]])
        # What is known needs no comparing and is dealt out evenly.
        anchor = np.where(
            kind == _KNOWN,
            arrays.mixed(docs.view(np.uint64) + r["start"].astype(np.uint64)),
            r["anchor"],
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(anchor.view(np.int64)),
                pa.array(r["whole"].view(np.int64)),
                pa.array(docs),
                pa.array(versions),
                pa.array(r["start"]),
                pa.array(r["count"].astype(np.int32)),
                pa.array(kind),
            ],
            ["anchor", "whole", "doc", "version", "start", "count", "kind"],
        )


def _pack(start, count, open_) -> np.ndarray:
    """A run in one number: start, number of windows, and whether it is to be taken apart."""
    return (start << 22) | (count.astype(np.int64) << 1) | open_.astype(np.int64)


def _unpack(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs >> 22, (runs >> 1) & ((1 << 21) - 1), (runs & 1).astype(bool)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Columns of sorted rows with those before and after each; a row of lag, no group held."""
    held: list[np.ndarray] | None = None  # the row before, and the one not yet passed on
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if not batch.num_rows:
            continue
        if held is None:
            # Before the first row there is one of another key.
            held = [np.array([~c[0], c[0]], dtype=c.dtype) for c in columns]
            columns = [c[1:] for c in columns]
        together = [np.concatenate((h, c)) for h, c in zip(held, columns)]
        yield [c[:-2] for c in together], [c[1:-1] for c in together], [c[2:] for c in together]
        held = [c[-2:] for c in together]
    if held is not None:
        yield (
            [c[:1] for c in held],
            [c[1:] for c in held],
            [np.array([~c[1]], dtype=c.dtype) for c in held],
        )


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that are repeated as a whole, and one to take apart of each kind of an anchor."""
    opening = None  # the first run seen of the anchor that is passing
    for before, now, after in _with_next(batches):
        anchor, whole, docs, versions, start, count, kind = now
        known = kind == _KNOWN
        same_before = (anchor == before[0]) & (whole == before[1]) & (before[-1] != _KNOWN)
        same_after = (anchor == after[0]) & (whole == after[1]) & (after[-1] != _KNOWN)
        repeated = known | (kind == _SEVERAL) | same_before | same_after
        # The first run of each anchor, carried over from batch to batch.
        new = anchor != before[0]
        at = np.maximum.accumulate(np.where(new, np.arange(len(anchor)), -1))
        first = np.where(at >= 0, whole[np.maximum(at, 0)], 0 if opening is None else opening)
        if len(anchor):
            opening = first[-1]
        last_of_kind = ~((anchor == after[0]) & (whole == after[1]))
        others = (whole != first) | (anchor == after[0])
        apart = ~known & last_of_kind & others
        none = np.zeros(len(anchor), dtype=bool)
        packed = np.concatenate(
            (
                _pack(start[repeated], count[repeated], none[repeated]),
                _pack(start[apart], count[apart], ~none[apart]),
            )
        )
        doc, version = (np.concatenate((x[repeated], x[apart])) for x in (docs, versions))
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(version), pa.array(packed)], ["doc", "version", "run"]
        )


def _window_rows(batches: Iterator[pa.RecordBatch], params: Repeats) -> Iterator[pa.RecordBatch]:
    """Every window of the runs that are to be taken apart."""
    width = params.length - params.gram + 1
    for batch in arrays.portions(batches, 2, _PORTION):
        docs, versions = (batch.column(k).to_numpy() for k in range(2))
        out = []
        for i in range(batch.num_rows):
            start, count, apart = _unpack(batch.column(3)[i].values.to_numpy())
            start, count = start[apart], count[apart]
            if not len(start):
                continue
            data = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint8)
            order = np.argsort(start)
            start, count = start[order], count[order]
            # Near runs are worked on as one piece of text.
            ends = start + count - 1 + params.length
            cuts = np.flatnonzero(start[1:] > np.maximum.accumulate(ends)[:-1]) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(start)]):
                base, top = int(start[low]), min(int(ends[low:high].max()), len(data))
                for piece in range(base, top - params.length + 1, _SLICE):
                    stop = min(piece + _SLICE, top - params.length + 1)
                    part = data[piece : stop - 1 + params.length]
                    inside = _covered(start[low:high], count[low:high], piece, stop)
                    if not len(inside):
                        continue
                    hashes = Hashes(part)
                    gram = hashes.all(params.gram)
                    key = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
                    at = (_sliding_min(key, width)[inside] & _PLACE).astype(np.int64)
                    window = hashes.of(inside, params.length)
                    row = np.full(len(inside), i)
                    out.append((window, gram[at], row, inside + piece))
        if not out:
            continue
        window, anchor, row, start = (np.concatenate([o[k] for o in out]) for k in range(4))
        doc = docs[row]
        kind = _combined([window, anchor])
        window = np.where(
            kind == _KNOWN, arrays.mixed(doc.view(np.uint64) + start.astype(np.uint64)), window
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(window.view(np.int64)),
                pa.array(anchor.view(np.int64).astype(np.int32)),
                pa.array(doc),
                pa.array(versions[row]),
                pa.array(start),
                pa.array(kind),
            ],
            ["window", "anchor", "doc", "version", "start", "kind"],
        )


def _covered(start: np.ndarray, count: np.ndarray, low: int, high: int) -> np.ndarray:
    """Places of [low, high) in any of the runs, from ``low`` on."""
    begins, ends = np.maximum(start, low) - low, np.minimum(start + count, high) - low
    good = begins < ends
    marks = np.zeros(high - low + 1, dtype=np.int64)
    np.add.at(marks, begins[good], 1)
    np.add.at(marks, ends[good], -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) > 0)


def _compare_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that are equal to another."""
    for before, now, after in _with_next(batches):
        window, anchor, docs, versions, start, kind = now
        same_before = (window == before[0]) & (anchor == before[1]) & (before[-1] != _KNOWN)
        same_after = (window == after[0]) & (anchor == after[1]) & (after[-1] != _KNOWN)
        again = (kind != _ALONE) | same_before | same_after
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[again]) for x in (docs, versions, start)], ["doc", "version", "start"]
        )


def _removed(
    batches: Iterator[pa.RecordBatch], length: int, texts: bool
) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in SPANS.split(", ")]
    for batch in arrays.portions(batches, 2, _PORTION):
        docs, versions = (batch.column(k).to_pylist() for k in range(2))
        out = []
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(2)[i].as_buffer(), dtype=np.uint8)
            start, count, apart = _unpack(batch.column(3)[i].values.to_numpy())
            single = batch.column(4)[i]
            single = single.values.to_numpy() if single.is_valid else np.empty(0, np.int64)
            begins = np.concatenate((start[~apart], single))
            ends = np.concatenate((start[~apart] + count[~apart] - 1, single)) + length
            order = np.argsort(begins, kind="stable")
            begins, ends = merged(begins[order], ends[order])
            kept = without(data, begins, ends)
            out.append(
                (
                    docs[i],
                    versions[i],
                    len(data) - len(kept),
                    begins.tolist(),
                    ends.tolist(),
                    hashlib.sha256(kept).hexdigest(),
                    kept if texts else None,
                )
            )
        yield table_batch(out, SPANS, names)

"""Words of many texts as arrays: positions and hashes, without a Python object each.

Texts come as one buffer of UTF-8 bytes with the offsets of the rows, as Arrow
holds them. A buffer is worked through in slices of about a megabyte, so what is
held besides it is a number for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SLICE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of ASCII white space.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: ASCII letters to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Words:
    """``start`` and ``end`` (in the buffer) and ``hash`` of each word; ``first`` word of each row."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a binary column; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def portions(
    batches: Iterator[pa.RecordBatch], text: int, most: int = 1 << 23
) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``most`` bytes of text, at least one row each."""
    for batch in batches:
        column = batch.column(text).cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
        offsets = offsets[column.offset : column.offset + len(column) + 1]
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1
            high = min(max(high, low + 1), batch.num_rows)
            yield batch.slice(low, high - low)
            low = high


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(29))
    values = values * np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    values = np.full(n, base, dtype=np.uint64)
    if n:
        values[0] = 1
    return np.multiply.accumulate(values)


def places(length: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of several runs of the given lengths."""
    return np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)


def words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray | None = None,
          separator: np.ndarray = IS_SPACE) -> Words:
    """The words of all rows: runs of bytes that are no ``separator``.

    The hash is over the bytes after ``fold`` (a table of 256), if there is one.
    """
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[offsets] = True
    found: list[tuple] = []
    low = 0
    while low < len(data):
        high = _slice_end(data, begins, separator, low)
        found.append(_words_of_slice(data, begins, low, high, fold, separator))
        low = high
    start, end, hashes = (
        (np.concatenate([f[i] for f in found]) for i in range(3))
        if found
        else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
    )
    return Words(start, end, hashes, np.searchsorted(start, offsets))


def _slice_end(data, begins, separator, low: int) -> int:
    """An end of a slice that cuts no word."""
    high = min(low + _SLICE, len(data))
    if high == len(data):
        return high
    back = np.flatnonzero(separator[data[low:high]] | begins[low + 1 : high + 1])
    if len(back):
        return low + int(back[-1]) + 1
    while high < len(data):  # one word longer than a slice
        more = np.flatnonzero(
            separator[data[high : high + _SLICE]] | begins[high : high + len(data[high : high + _SLICE])]
        )
        if len(more):
            return high + int(more[0])
        high = min(high + _SLICE, len(data))
    return high


def _words_of_slice(data, begins, low, high, fold, separator) -> tuple:
    part = data[low:high]
    inside = ~separator[part]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    opens = inside & (~before | begins[low:high])
    start = np.flatnonzero(opens)
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    letters = part[inside]
    # In the letters without separators, word k begins at where[k].
    where = np.flatnonzero(opens[inside])
    length = np.diff(np.append(where, len(letters)))
    if fold is not None:
        letters = fold[letters]
    place = np.arange(len(letters)) - np.repeat(where, length)
    terms = (letters.astype(np.uint64) + np.uint64(1)) * powers(int(length.max()))[place]
    hashes = mixed(np.add.reduceat(terms, where) + length.astype(np.uint64))
    return start + low, start + low + length, hashes


def hash_runs(hashes: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each run of word hashes; run k begins at ``first[k]``, none is empty."""
    if not len(first):
        return np.empty(0, np.uint64)
    length = np.diff(np.append(first, len(hashes)))
    place = np.arange(len(hashes)) - np.repeat(first, length)
    base = mixed(np.array([seed], dtype=np.uint64))[0] | np.uint64(1)
    terms = hashes * powers(int(length.max()), base)[place]
    return mixed(np.add.reduceat(terms, first) + length.astype(np.uint64))

"""Duplicate passages by hashing units of text over the whole corpus.

A unit is a sentence of a line: it ends at a line end, or after a word that ends
in ``.``, ``!`` or ``?``. Units are normalised (white space, ASCII case) and
hashed; of equal units the one in the document with the smallest id is kept, and
there the first. The others are removed, at any length where their line has no
unit that stays for being new. Inside a line that has one they need enough words
together with their removed neighbours: a short sentence that recurs by chance (or
an abbreviation, which ends one too) stays there, and a passage goes with its short
sentences. Offsets are those of the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored

#: Stands for a null id: after all others.
NO_ID = 2**63 - 1

_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord(c) for c in ".!?"]] = True

CLEANED = (
    "doc_id long, n_units long, n_removed_units long, n_bytes long, n_removed long, "
    "span_starts array<long>, span_ends array<long>, kept_sha256 string, kept_text binary"
)


@dataclass(frozen=True)
class LineHashing:
    """Parameters: words that a removed run of units has at least, and whether that
    holds only for lines that have a new unit as well (``whole_lines``)."""

    least_words: int = 10
    whole_lines: bool = False


WHOLE = LineHashing(whole_lines=True)


def drop_repeated_units(
    docs: DataFrame,
    params: LineHashing = WHOLE,
    id_column: str = "doc_id",
    text_column: str = "text",
    texts: bool = True,
) -> DataFrame:
    """A row per row of ``docs`` with the removed spans and what is kept.

    Columns as in ``CLEANED``; spans are byte ranges of the original text in
    UTF-8, in order, and reach to the next unit. ``kept_text`` is null without
    ``texts``.

    * A null text is empty, a text without words has no units; both stay as they are.
    * Rows that repeat an id are one document listed again: a unit that is
      removed for one is removed for each. All rows with a null id count as one
      document, after all others.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    rows = docs.select(
        F.coalesce(quoted(id_column).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
    )
    units = rows.mapInArrow(_unit_hashes, "doc long, one long, two long")
    # At most one row per document and unit from each task: sums, so a unit in a
    # third of all documents is no more work than others.
    groups = (
        units.groupBy("one", "two")
        .agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("one", "two", "first")
    )
    repeated = units.join(groups, ["one", "two"]).filter("doc <> first")
    by_doc = stored(
        repeated.groupBy("doc").agg(F.collect_list("one").alias("repeated")), "repeated-units"
    )
    joined = rows.join(by_doc, "doc", "left").select("doc", "text", "repeated")
    return joined.mapInArrow(lambda b: _cleaned(b, params, texts), CLEANED)


@dataclass(frozen=True)
class Units:
    """Byte ranges, words and hashes of the units of all rows; ``row`` of each, and
    whether it ``opens`` a line."""

    row: np.ndarray
    start: np.ndarray
    words: np.ndarray
    one: np.ndarray
    two: np.ndarray
    opens: np.ndarray


def units_of(data: np.ndarray, offsets: np.ndarray, sentences: bool = True) -> Units:
    """The units of texts given as one buffer; lines only, without ``sentences``."""
    w = arrays.words(data, offsets, fold=arrays.LOWER)
    n = len(w.start)
    if not n:
        none = np.empty(0, np.int64)
        return Units(
            none, none, none, np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, bool)
        )
    breaks = np.zeros(n, dtype=bool)
    line_ends = np.flatnonzero(data == 10)
    # A line end between two words: as many of them before one as before the other, or not.
    lines = np.searchsorted(line_ends, w.start)
    breaks[1:] = lines[1:] != lines[:-1]
    breaks[w.first[:-1][w.first[:-1] < n]] = True
    opens = breaks.copy()
    if sentences:
        breaks[1:] |= _ENDS[data[w.end[:-1] - 1]]
    first = np.flatnonzero(breaks)
    return Units(
        np.searchsorted(w.first, first, side="right") - 1,
        w.start[first],
        np.diff(np.append(first, n)),
        arrays.hash_runs(w.hash, first, 1),
        arrays.hash_runs(w.hash, first, 2),
        opens[first],
    )


def _unit_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each unit of a document once."""
    for batch in arrays.portions(batches, 1):
        units = units_of(*arrays.texts_of(batch.column(1)))
        order = np.lexsort((units.one, units.row))
        row, one, two = units.row[order], units.one[order], units.two[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (one[1:] != one[:-1])
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(docs[row[new]]),
                pa.array(one[new].view(np.int64)),
                pa.array(two[new].view(np.int64)),
            ],
            ["doc", "one", "two"],
        )


def _cleaned(
    batches: Iterator[pa.RecordBatch], params: LineHashing, texts: bool
) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in CLEANED.split(", ")]
    for batch in arrays.portions(batches, 1):
        data, offsets = arrays.texts_of(batch.column(1))
        units = units_of(data, offsets)
        first = np.searchsorted(units.row, np.arange(batch.num_rows + 1))
        docs, repeated = batch.column(0).to_pylist(), batch.column(2)
        out = []
        for i in range(batch.num_rows):
            part = slice(first[i], first[i + 1])
            elsewhere = np.array(repeated[i].as_py() or [], dtype=np.int64).view(np.uint64)
            opens = units.opens[part] if params.whole_lines else None
            removed = _removed(
                units.one[part], units.words[part], elsewhere, params.least_words, opens
            )
            begins = units.start[part] - offsets[i]
            ends = np.append(begins[1:], offsets[i + 1] - offsets[i]) if len(begins) else begins
            text = data[offsets[i] : offsets[i + 1]]
            spans = merged(begins[removed], ends[removed])
            kept = without(text, *spans)
            size = len(text)
            out.append(
                (
                    None if docs[i] == NO_ID else docs[i],
                    len(begins),
                    int(removed.sum()),
                    size,
                    size - len(kept),
                    spans[0].tolist(),
                    spans[1].tolist(),
                    hashlib.sha256(kept).hexdigest(),
                    kept if texts else None,
                )
            )
        yield table_batch(out, CLEANED, names)


def _removed(hashes, words, elsewhere, least: int, opens=None) -> np.ndarray:
    """Which units of a document go: repeated ones, in runs of enough words, or in a
    line without others if it is known which ones open lines."""
    again = np.isin(hashes, elsewhere)
    _, seen_first = np.unique(hashes, return_index=True)
    later = np.ones(len(hashes), dtype=bool)
    later[seen_first] = False
    again |= later
    if not again.any():
        return again
    whole = np.zeros(len(hashes), dtype=bool)
    if opens is not None:
        line = np.cumsum(opens) - 1
        whole = np.bincount(line, weights=~again)[line] == 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], again, [False])).astype(np.int8)))
    total = np.concatenate(([0], np.cumsum(words)))
    for low, high in edges.reshape(-1, 2):
        if total[high] - total[low] < least:
            again[low:high] = False
    return again | whole


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ranges, with those that meet or overlap put together."""
    if not len(begins):
        return begins, ends
    reach = np.maximum.accumulate(ends)
    opens = np.concatenate(([True], begins[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(opens)[1:] - 1, len(begins) - 1)
    return begins[opens], reach[last]


def without(text: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> bytes:
    """The bytes outside of the ranges."""
    lows, highs = np.concatenate(([0], ends)), np.concatenate((begins, [len(text)]))
    return b"".join(text[low:high].tobytes() for low, high in zip(lows.tolist(), highs.tolist()))


def table_batch(rows: list[tuple], schema: str, names: list[str]) -> pa.RecordBatch:
    """Rows as a batch with the types of a Spark schema in DDL."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
        "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    }
    types = [kinds[field.split()[1]] for field in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

"""Ranked lexical search turned round: the items are indexed, the documents stream past.

The terms of the items make an inverted index, which every task holds. A document's
term counts run through it and give the document's score for each item that shares a
term; a task keeps the best few documents of each item, and these small heaps are
merged. Documents are neither indexed nor sorted, and no pair of document and item is
ever a row of a table.

Items come in blocks whose index has a bounded number of entries, however many items
there are; each block is one reading of the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored

#: Terms are runs of ASCII letters and digits and of all bytes of other characters.
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[48:58] = SEPARATOR[65:91] = SEPARATOR[97:123] = SEPARATOR[128:] = False

#: Entries of a table of scores, and index entries looked up, at once in a task.
_AT_ONCE = 1 << 21


@dataclass(frozen=True)
class Search:
    """Parameters.

    ``most`` documents are returned for an item. The index of a block of items has
    ``block_entries`` entries (a term of an item) at most, or a single item. A term
    counts with ``saturation`` hundredths of its document's length, of which
    ``length_share`` hundredths are relative to the mean length.
    """

    most: int = 10
    block_entries: int = 500_000
    saturation: int = 8
    length_share: int = 90


@dataclass(frozen=True)
class Index:
    """Terms in order of their hash, and for each the items that have it."""

    hash: np.ndarray
    letters: np.ndarray  # bytes of all terms
    at: np.ndarray  # where each term's bytes begin; one more than terms
    first: np.ndarray  # where each term's items begin; one more than terms
    item: np.ndarray
    ids: pa.Array  # of the items

    def __post_init__(self):
        object.__setattr__(self, "unique", len(np.unique(self.hash)) == len(self.hash))


def search(
    docs: DataFrame,
    items: DataFrame,
    params: Search = Search(),
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The best documents of each item: the item's id, ``rank``, the document's id, ``score``.

    A term is a maximal run of ``[0-9A-Za-z]`` and non-ASCII characters, with A-Z
    lower-cased. ``N`` documents have a term, ``L`` terms in all; a document has
    ``n``, and ``tf`` of one term, which ``df`` documents hold. A term weighs
    ``w = floor(1000 ln((2N+2)/(2df+1)))``, and a score is the sum of
    ``w * (10^9 tf div (1000 tf + 8 m))`` over the terms of an item, once each, with
    ``m = 10 + (90 n N) div L``. Only scores above 0 count; equal ones are ranked by
    the document's id, which is an integer, null last.

    * Null and empty texts have no terms; an item without terms has no documents.
    * Rows of ``items`` that share an id, null included, are one item with the terms of
      all of them. Rows of ``docs`` that share an id are documents of their own.
    * Terms are compared by their bytes, not by hashes alone. Whole texts are read.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    require_columns(items, item_column, item_text_column)
    if item_column in ("rank", "score", id_column):
        raise ValueError(f"{item_column} would appear twice in the result")
    rows = docs.select(
        quoted(id_column).cast("long").alias("doc"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
    )
    kind = dict(items.select(quoted(item_column).alias("item")).dtypes)["item"]
    entries = items.select(
        quoted(item_column).alias("item"),
        F.coalesce(quoted(item_text_column), F.lit("")).cast("binary").alias("text"),
    ).mapInArrow(_terms, f"item {kind}, term string")
    entries = stored(entries.distinct(), "item-terms")
    found = [
        _block(rows, entries.filter(chosen), kind, params) for chosen in _blocks(entries, params)
    ]
    best = reduce(DataFrame.unionByName, found) if found else _nothing(docs.sparkSession, kind)
    return best.select(
        F.col("item").alias(item_column), "rank", F.col("doc").alias(id_column), "score"
    )


def _nothing(spark, kind: str) -> DataFrame:
    return spark.createDataFrame([], f"item {kind}, rank int, doc long, score long")


def _blocks(entries: DataFrame, params: Search) -> list:
    """Conditions that deal the items out to blocks of bounded entries."""
    size = entries.count()
    if not size:
        return []
    sizes = entries.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    blocks = 1
    while True:
        block = F.pmod(F.xxhash64("item"), F.lit(blocks))
        largest = (
            sizes.groupBy(block.alias("b"))
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
            .filter("items > 1")
            .agg(F.max("n"))
            .first()[0]
        )
        if (largest or 0) <= params.block_entries or blocks > size:
            return [block == b for b in range(blocks)]
        blocks = max(2 * blocks, math.ceil(size / params.block_entries))


def _block(rows: DataFrame, entries: DataFrame, kind: str, params: Search) -> DataFrame:
    """The best documents of each item of one block."""
    spark = rows.sparkSession
    index = _index(entries.orderBy("term", "item").toArrow())
    if not len(index.hash):
        return _nothing(spark, kind)
    sent = spark.sparkContext.broadcast(index)
    counts = rows.mapInArrow(
        lambda b: _counts(b, sent.value), "doc long, n long, terms array<int>, times array<long>"
    )
    counts = stored(counts, "term-counts")
    total = counts.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return _nothing(spark, kind)
    holders = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(index.hash), dtype=np.int64)
    df[holders.column(0).to_numpy()] = holders.column(1).to_numpy()
    weight = np.array(
        [math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * n + 1))) for n in df.tolist()],
        dtype=np.int64,
    )
    sizes = (total["docs"], total["terms"])
    heaps = counts.mapInArrow(
        lambda b: _heaps(b, sent.value, weight, sizes, params),
        f"item {kind}, doc long, score long",
    )
    order = F.row_number().over(
        Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    )
    best = heaps.withColumn("rank", order).filter(F.col("rank") <= params.most)
    return best.select("item", "rank", "doc", "score")


def _index(entries: pa.Table) -> Index:
    """The index of (item, term) rows that are sorted by term."""
    items = entries.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    terms = entries.column("term").cast(pa.binary()).combine_chunks().dictionary_encode()
    if isinstance(items, pa.ChunkedArray):
        items, terms = items.combine_chunks(), terms.combine_chunks()
    letters, at = arrays.texts_of(terms.dictionary)
    words = arrays.words(letters, at, separator=SEPARATOR)
    order = np.argsort(words.hash, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    of = place[terms.indices.to_numpy()]
    by_term = np.argsort(of, kind="stable")
    length = np.diff(at)[order]
    source = np.repeat(at[:-1][order], length) + arrays.places(length)
    ends = np.concatenate(([0], np.cumsum(length)))
    first = np.searchsorted(of[by_term], np.arange(len(order) + 1))
    item = items.indices.to_numpy()[by_term].astype(np.int64)
    return Index(words.hash[order], letters[source], ends, first, item, items.dictionary)


# --- in tasks --------------------------------------------------------------


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each term of each item, in lower case."""
    for batch in arrays.portions(batches, 1):
        data, offsets = arrays.texts_of(batch.column(1))
        w = arrays.words(data, offsets, fold=arrays.LOWER, separator=SEPARATOR)
        lower = arrays.LOWER[data].tobytes()
        row = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
        terms = [lower[a:b].decode() for a, b in zip(w.start.tolist(), w.end.tolist())]
        items = batch.column(0).take(pa.array(row))
        yield pa.RecordBatch.from_arrays([items, pa.array(terms, pa.string())], ["item", "term"])


def _place(data: np.ndarray, w: arrays.Words, index: Index) -> np.ndarray:
    """Place in the index of each word, -1 for others; bytes are compared."""
    if not index.unique:
        lower = arrays.LOWER[data].tobytes()
        letters = index.letters.tobytes()
        known = {letters[a:b]: i for i, (a, b) in enumerate(zip(index.at, index.at[1:]))}
        found = [known.get(lower[a:b], -1) for a, b in zip(w.start.tolist(), w.end.tolist())]
        return np.array(found, dtype=np.int64)
    at = np.searchsorted(index.hash, w.hash)
    at[at == len(index.hash)] = 0
    length = w.end - w.start
    same = (index.hash[at] == w.hash) & (np.diff(index.at)[at] == length)
    which = np.flatnonzero(same)
    length, within = length[which], arrays.places(length[which])
    ours = arrays.LOWER[data[np.repeat(w.start[which], length) + within]]
    differs = ours != index.letters[np.repeat(index.at[at[which]], length) + within]
    if differs.any():
        same[np.unique(np.repeat(which, length)[differs])] = False
    return np.where(same, at, -1)


def _counts(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Of each document with a term: how many it has, and how often those of the index."""
    size = len(index.hash)
    for batch in arrays.portions(batches, 1):
        data, offsets = arrays.texts_of(batch.column(1))
        w = arrays.words(data, offsets, fold=arrays.LOWER, separator=SEPARATOR)
        n = np.diff(w.first)
        place = _place(data, w, index)
        row = np.repeat(np.arange(batch.num_rows), n)
        code, times = np.unique((row * size + place)[place >= 0], return_counts=True)
        ends = np.searchsorted(code, np.arange(batch.num_rows + 1) * size)
        ends = pa.array(ends.astype(np.int32))
        out = pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n.astype(np.int64)),
                pa.ListArray.from_arrays(ends, pa.array((code % size).astype(np.int32))),
                pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int64))),
            ],
            ["doc", "n", "terms", "times"],
        )
        yield out.filter(pa.array(n > 0))


def length_weight(n: np.ndarray, sizes: tuple[int, int], share: int) -> np.ndarray:
    """``m`` of documents with ``n`` terms each."""
    docs, terms = sizes
    if share * int(n.max(initial=0)) * docs < 1 << 63:
        relative = share * n * docs // terms
    else:
        relative = np.array([share * x * docs // terms for x in n.tolist()], dtype=np.int64)
    return 100 - share + relative


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, items: int, most: int):
        self._items, self._most = items, most
        # The least score that can still enter.
        self._floor = np.ones(items, dtype=np.int64)
        none = np.empty(0, dtype=np.int64)
        self.item, self.score, self.doc, self.null = none, none, none, none.astype(bool)

    def add(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """A table of scores: a row for each document, a column for each item."""
        row, item = np.nonzero(scores >= self._floor)
        if not len(row):
            return
        item = np.concatenate((self.item, item))
        score = np.concatenate((self.score, scores[row, item[len(self.item) :]]))
        doc = np.concatenate((self.doc, doc[row]))
        null = np.concatenate((self.null, null[row]))
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], np.arange(self._items + 1))
        rank = np.arange(len(order)) - np.repeat(first[:-1], np.diff(first))
        order = order[rank < self._most]
        self.item, self.score, self.doc, self.null = (x[order] for x in (item, score, doc, null))
        last = rank[rank < self._most] == self._most - 1
        self._floor[self.item[last]] = self.score[last]


def _heaps(
    batches: Iterator[pa.RecordBatch],
    index: Index,
    weight: np.ndarray,
    sizes: tuple[int, int],
    params: Search,
) -> Iterator[pa.RecordBatch]:
    items = len(index.ids)
    heaps = Heaps(items, params.most)
    entries = np.diff(index.first)
    rows_at_once = 64  # few at first, when any score enters
    for batch in batches:
        ids = batch.column(0)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        doc = ids.fill_null(0).to_numpy()
        first = _offsets(batch.column(2))
        term, times = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (2, 3))
        m = length_weight(batch.column(1).to_numpy(), sizes, params.length_share)
        row = np.repeat(np.arange(batch.num_rows), np.diff(first))
        gain = weight[term] * (
            1_000_000_000 * times // (1000 * times + params.saturation * m[row])
        )
        # How many entries are looked up before each row.
        before = np.concatenate(([0], np.cumsum(entries[term])))[first]
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(before, before[low] + _AT_ONCE, side="right")) - 1
            high = min(max(high, low + 1), low + rows_at_once, batch.num_rows)
            rows_at_once = min(2 * rows_at_once, max(1, _AT_ONCE // items))
            part = slice(first[low], first[high])
            many = entries[term[part]]
            at = np.repeat(index.first[term[part]], many) + arrays.places(many)
            scores = np.zeros((high - low) * items, dtype=np.int64)
            cell = np.repeat((row[part] - low) * items, many) + index.item[at]
            np.add.at(scores, cell, np.repeat(gain[part], many))
            heaps.add(scores.reshape(high - low, items), doc[low:high], null[low:high])
            low = high
    yield pa.RecordBatch.from_arrays(
        [
            index.ids.take(pa.array(heaps.item)),
            pa.array(heaps.doc, mask=heaps.null),
            pa.array(heaps.score),
        ],
        ["item", "doc", "score"],
    )


def _offsets(lists: pa.Array) -> np.ndarray:
    """Where each list begins in the flattened values; one more than lists."""
    return np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))))

"""Overlapping documents by shared runs of lines, aligned by patience diff.

A block that is deleted is a run of consecutive lines of enough words that two
documents share. So the runs that just reach these words are hashed, from each
line on and up to each line: every line of a block is in one that lies within the
block. Each document is paired with the first holder of each of its runs, which
makes no more pairs than there are runs. Where patience diff leaves a line of a
shared run in place (because the order differs, say), the document is paired with
the further earlier holders of that run too, some at a time, until the line goes or
no earlier holder is left. What is deleted is thus the same as over all pairs.

A pair is aligned by patience diff: lines that both have once are anchors, the
longest increasing run of them is kept, and the parts between are aligned in the
same way. Aligned blocks of enough words are deleted from the document with the
larger id.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored
from tierline.llm.line_hashing import NO_ID, merged, table_batch, units_of

LINES = (
    "doc long, n_bytes long, lines array<long>, words array<long>, starts array<long>, "
    "keys array<long>"
)
#: Of the base of ``arrays.powers``, modulo 2^64.
_INVERSE = np.uint64(pow(int(arrays._BASE), -1, 2**64))

SPANS = (
    "doc long, n_bytes long, n_lines long, n_removed_lines long, n_removed long, "
    "span_starts array<long>, span_ends array<long>"
)


@dataclass(frozen=True)
class Alignment:
    """Parameters: words of a block that is deleted, and whether all documents that
    share one are followed up.

    Without ``every_block`` only those are paired that share a line of
    ``anchor_words``: all of up to ``rare`` documents, of more each with the first.
    That can miss blocks.
    """

    rare: int = 6
    anchor_words: int = 5
    block_words: int = 10
    every_block: bool = False


WHOLE = Alignment(every_block=True)


def aligned_spans(
    docs: DataFrame,
    params: Alignment = WHOLE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row per row of ``docs`` with the byte ranges to delete from its text.

    Columns: the id, ``n_bytes``, ``n_lines`` (with a word), ``n_removed_lines``,
    ``n_removed`` (bytes), ``span_starts`` and ``span_ends`` (of the original, in
    UTF-8). Lines are compared by their words, without ASCII case; a span reaches
    from the first word of a line to that of the next line that stays. Documents
    are compared as given, not as they are after deletions.

    * A null text is empty; texts without words have no lines.
    * Rows that repeat an id are one document listed again, and not compared with
      each other; the spans found for one hold for each, cut at its end. All
      rows with a null id count as one document, after all others.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    rows = docs.select(
        F.coalesce(quoted(id_column).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
    )
    lines = stored(rows.mapInArrow(lambda b: _lines(b, params), LINES), "aligned-lines")
    if params.every_block:
        removed = _all_removed(lines, params.block_words)
    else:
        pairs = stored(_pairs(lines, params), "aligned-pairs")
        removed = _compared(pairs, lines, params.block_words)
    removed = _gathered(removed)
    joined = lines.join(removed, lines["doc"] == removed["b"], "left").select(
        "doc", "n_bytes", "starts", "removed"
    )
    spans = joined.mapInArrow(_spans, SPANS)
    return spans.select(
        F.nullif(F.col("doc"), F.lit(NO_ID)).alias(id_column), *spans.columns[1:]
    )


def drop_aligned_blocks(
    docs: DataFrame,
    params: Alignment = WHOLE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with the aligned blocks cut out of the texts; cases as above.

    Every row stays, also one of which nothing is left; a null text stays null.
    """
    spans = aligned_spans(docs, params, id_column, text_column)
    spans = spans.filter("n_removed > 0").groupBy(F.col(id_column).alias("__id")).agg(
        F.first("span_starts").alias("__starts"), F.first("span_ends").alias("__ends")
    )
    row = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("__doc"),
        quoted(id_column).cast("long").alias("__own"),
    )
    joined = row.join(spans, F.col("__own").eqNullSafe(F.col("__id")), "left")
    text = F.col("__doc")[text_column].cast("binary")
    begins = F.concat(F.array(F.lit(0).cast("long")), "__ends")
    ends = F.concat("__starts", F.array(F.octet_length(text).cast("long")))
    kept = F.transform(
        F.arrays_zip(begins.alias("low"), ends.alias("high")),
        lambda s: F.substring(text, (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")),
    )
    cut = F.aggregate(kept, F.lit(b""), lambda acc, x: F.concat(acc, x)).cast("string")
    return joined.select(
        *[
            (F.when(F.col("__starts").isNull(), F.col("__doc")[c]).otherwise(cut)
             if c == text_column else F.col("__doc")[c]).alias(c)
            for c in docs.columns
        ]
    )


def _all_removed(lines: DataFrame, least: int) -> DataFrame:
    """Lines ``removed`` from documents ``b``, in any number of rows for each."""
    shared = stored(_shared(lines), "aligned-runs")
    removed = _compared(shared.select(F.explode("firsts").alias("a"), "b"), lines, least)
    left = stored(_uncovered(shared.select("b", "runs"), lines, removed, least), "aligned-left")
    if left.isEmpty():
        return removed
    owned = lines.select("doc", F.explode("keys").alias("run"))
    of_left = owned.join(left.select("run").distinct(), "run", "left_semi").distinct()
    place = F.row_number().over(Window.partitionBy("run").orderBy("doc")) - 1
    holders = stored(of_left.withColumn("place", place), "aligned-holders")
    own = holders.select("run", F.col("doc").alias("b"), F.col("place").alias("own"))
    low, high = 1, 5  # place 0 is the first holder
    while True:
        # Earlier holders of a run have the places before that of ``b``.
        left = stored(left.join(own, ["run", "b"]).filter(F.col("own") > low).drop("own"), "aligned-open")
        if left.isEmpty():
            return removed
        some = holders.filter(F.col("place").between(low, high - 1)).select("run", F.col("doc").alias("a"))
        pairs = left.join(some, "run").filter("a < b").select("a", "b").distinct()
        removed = removed.union(_compared(pairs, lines, least))
        runs = left.groupBy("b").agg(F.collect_list("run").alias("runs"))
        left = _uncovered(runs, lines, removed, least)
        low, high = high, 4 * high


def _shared(lines: DataFrame) -> DataFrame:
    """For documents ``b``: their ``runs`` that an earlier one has too, and the ``firsts`` of these."""
    owned = lines.select("doc", F.explode("keys").alias("run"))
    shared = (
        owned.groupBy("run").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .filter("first < last")
        .drop("last")
    )
    return (
        owned.join(shared, "run")
        .filter("first < doc")
        .groupBy(F.col("doc").alias("b"))
        .agg(F.collect_list("run").alias("runs"), F.collect_set("first").alias("firsts"))
    )


def _compared(pairs: DataFrame, lines: DataFrame, least: int) -> DataFrame:
    """Lines ``removed`` from ``b`` for pairs (a, b) of documents, where there are any."""
    parts = lines.select("doc", "lines", "words")
    later = pairs.join(parts.toDF("b", "b_lines", "b_words"), "b")
    both = later.join(parts.drop("words").toDF("a", "a_lines"), "a")
    found = both.select("b", "a_lines", "b_lines", "b_words").mapInArrow(
        lambda x: _aligned(x, least), "b long, removed array<long>"
    )
    return stored(found, "aligned-blocks")


def _gathered(removed: DataFrame) -> DataFrame:
    """A row per document with all its removed lines."""
    lines = F.array_distinct(F.flatten(F.collect_list("removed"))).alias("removed")
    return removed.groupBy("b").agg(lines)


def _uncovered(runs: DataFrame, lines: DataFrame, removed: DataFrame, least: int) -> DataFrame:
    """(b, run) for those of ``runs`` of which a line stays."""
    own = lines.select(F.col("doc").alias("b"), "lines", "words")
    joined = runs.join(own, "b").join(_gathered(removed), "b", "left")
    found = joined.select("b", "lines", "words", "runs", "removed").mapInArrow(
        lambda x: _staying(x, least), "b long, runs array<long>"
    )
    return found.select("b", F.explode("runs").alias("run")).distinct()


def _pairs(lines: DataFrame, params: Alignment) -> DataFrame:
    """Distinct pairs (a, b) of documents that share an anchor, a before b, as ``Alignment`` limits them."""
    owned = lines.select("doc", F.explode("keys").alias("line")).distinct()
    shared = (
        owned.groupBy("line")
        .agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    members = owned.join(shared, "line")
    with_first = members.filter("doc <> first").select(F.col("first").alias("a"), F.col("doc").alias("b"))
    # At most ``rare`` documents in each list.
    few = members.filter(F.col("n") <= params.rare).groupBy("line").agg(
        F.sort_array(F.collect_list("doc")).alias("docs")
    )
    each = few.select("docs", F.posexplode("docs").alias("at", "a"))
    others = F.slice("docs", F.col("at") + 2, F.size("docs"))
    return with_first.union(each.select("a", F.explode(others).alias("b"))).distinct()


# --- in tasks --------------------------------------------------------------


def _lines(batches: Iterator[pa.RecordBatch], params: Alignment) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in LINES.split(", ")]
    for batch in arrays.portions(batches, 1):
        data, offsets = arrays.texts_of(batch.column(1))
        units = units_of(data, offsets, sentences=False)
        first = np.searchsorted(units.row, np.arange(batch.num_rows + 1))
        hashes = units.one.view(np.int64)
        long_enough = units.words >= params.anchor_words
        docs, out = batch.column(0).to_pylist(), []
        for i in range(batch.num_rows):
            part = slice(first[i], first[i + 1])
            own = hashes[part]
            if params.every_block:
                keys = runs_of(own, units.words[part], params.block_words)[2]
            else:
                keys = own[long_enough[part]]
            out.append(
                (
                    docs[i],
                    int(offsets[i + 1] - offsets[i]),
                    own,
                    units.words[part],
                    units.start[part] - offsets[i],
                    np.unique(keys),
                )
            )
        yield table_batch(out, LINES, names)


def _values(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy() if column[i].is_valid else np.empty(0, np.int64)


def runs_of(hashes: np.ndarray, words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line, line after the last, and hash of the runs of just enough words.

    The shortest from each line on and the shortest up to each line; a run of
    enough words has each of its lines in one of them that lies within it.
    """
    n, total = len(hashes), np.concatenate(([0], np.cumsum(words)))
    least = max(least, 1)
    low = np.arange(n)
    high = np.searchsorted(total, total[:-1] + least)
    up_to = np.arange(1, n + 1)
    since = np.searchsorted(total, total[1:] - least, side="right") - 1
    low = np.concatenate((low[high <= n], since[since >= 0]))
    high = np.concatenate((high[high <= n], up_to[since >= 0]))
    # Sums of line hashes times powers, moved to where the run begins.
    terms = hashes.view(np.uint64) * arrays.powers(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    value = (sums[high] - sums[low]) * arrays.powers(n + 1, _INVERSE)[low]
    return low, high, arrays.mixed(value + (high - low).astype(np.uint64)).view(np.int64)


def _staying(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The given runs of each document that have a line which is not removed."""
    for batch in batches:
        b, out = batch.column(0).to_pylist(), []
        for i in range(batch.num_rows):
            hashes, words, asked, removed = (_values(batch.column(k), i) for k in (1, 2, 3, 4))
            low, high, run = runs_of(hashes, words, least)
            stays = np.ones(len(hashes), dtype=np.int64)
            stays[removed[removed < len(hashes)]] = 0
            total = np.concatenate(([0], np.cumsum(stays)))
            left = np.unique(run[(total[high] > total[low]) & np.isin(run, asked)])
            if len(left):
                out.append((b[i], left))
        yield table_batch(out, "b long, runs array<long>", ["b", "runs"])


def _aligned(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        b, out = batch.column(0).to_pylist(), []
        for i in range(batch.num_rows):
            x, y, words = (_values(batch.column(k), i) for k in (1, 2, 3))
            removed = blocks(patience(x.tolist(), y.tolist()), words, least)
            if removed:
                out.append((b[i], removed))
        yield table_batch(out, "b long, removed array<long>", ["b", "removed"])


def patience(x: Sequence[int], y: Sequence[int]) -> list[tuple[int, int]]:
    """Matched places of two sequences, rising in both.

    Elements that only one of them has are left out first. Common beginnings and
    ends are matched; between them the elements that both have exactly once, in
    their longest increasing order; the parts in between likewise. A part without
    such elements is matched at its ends alone.
    """
    common = set(x).intersection(y)
    a = [(v, i) for i, v in enumerate(x) if v in common]
    b = [(v, j) for j, v in enumerate(y) if v in common]
    found: list[tuple[int, int]] = []
    parts = [(0, len(a), 0, len(b))]
    while parts:
        al, ah, bl, bh = parts.pop()
        while al < ah and bl < bh and a[al][0] == b[bl][0]:
            found.append((a[al][1], b[bl][1]))
            al, bl = al + 1, bl + 1
        while al < ah and bl < bh and a[ah - 1][0] == b[bh - 1][0]:
            ah, bh = ah - 1, bh - 1
            found.append((a[ah][1], b[bh][1]))
        if al == ah or bl == bh:
            continue
        chosen = _rising(_once_in_both(a, al, ah, b, bl, bh))
        if not chosen:
            continue
        for i, j in chosen:
            found.append((a[i][1], b[j][1]))
        edges = [(al - 1, bl - 1), *chosen, (ah, bh)]
        parts += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(found)


def _once_in_both(a, al, ah, b, bl, bh) -> list[tuple[int, int]]:
    """Places of the elements that each part has exactly once, in the order of the first."""
    in_a = Counter(a[i][0] for i in range(al, ah))
    in_b = Counter(b[j][0] for j in range(bl, bh))
    at = {b[j][0]: j for j in range(bl, bh)}
    return [
        (i, at[a[i][0]])
        for i in range(al, ah)
        if in_a[a[i][0]] == 1 and in_b.get(a[i][0]) == 1
    ]


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises in the second place too, by piles."""
    tops: list[int] = []
    pile_top: list[int] = []
    below: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        below.append(pile_top[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            pile_top.append(k)
        else:
            tops[pile], pile_top[pile] = j, k
    chosen, k = [], pile_top[-1] if pile_top else -1
    while k >= 0:
        chosen.append(pairs[k])
        k = below[k]
    return chosen[::-1]


def blocks(matched: list[tuple[int, int]], words, least: int) -> list[int]:
    """Lines of the second text in blocks, adjacent in both texts, of enough words."""
    removed: list[int] = []
    low = 0
    for k in range(1, len(matched) + 1):
        if k < len(matched) and matched[k] == (matched[k - 1][0] + 1, matched[k - 1][1] + 1):
            continue
        block = [j for _, j in matched[low:k]]
        if sum(int(words[j]) for j in block) >= least:
            removed += block
        low = k
    return removed


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [field.split()[0] for field in SPANS.split(", ")]
    for batch in batches:
        docs, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out = []
        for i in range(batch.num_rows):
            starts, gone = _values(batch.column(2), i), np.sort(_values(batch.column(3), i))
            n = len(starts)
            gone = gone[gone < n]
            ends = np.append(starts[1:], sizes[i])
            begins, ends = merged(starts[gone], ends[gone])
            out.append(
                (docs[i], sizes[i], n, len(gone), int((ends - begins).sum()),
                 begins.tolist(), ends.tolist())
            )
        yield table_batch(out, SPANS, names)

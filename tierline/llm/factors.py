"""Quality by a factorisation machine over words, structure and metadata of a document.

A document is a sparse vector: the words of its text, hashed and weighed by how often
they occur; what its lines, words and characters are like, each statistic as one of a
few quantile bins; and numbers that come with the text, binned alike. Every feature has
a weight and a short vector, and any two features of a document interact by the product
of their vectors: that many repetitions matter together with long lines, or a word with
the kind of text around it, needs no feature of its own. The sum over all pairs is half
of ``(sum of x v)^2 - sum of (x v)^2``, so a document is scored in time linear in
its features.

The machine is fitted on a bounded sample of labelled documents, whose features tasks
compute; scoring reads every text once and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored

#: Statistics of the structure of a text, in the order of ``structure``.
STATISTICS = (
    "bytes", "words", "lines", "words_per_line", "bytes_per_word", "different_words",
    "commonest_word", "words_like_the_one_before", "upper_case", "digits", "punctuation",
    "symbols", "beyond_ascii", "words_without_letters", "lines_without_words",
)

_LINE_END = 10
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LETTER = _UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_PUNCTUATION = np.isin(_BYTES, list(b".,;:!?'\"()-"))
_BEYOND = _BYTES >= 0xC0
_SYMBOL = (_BYTES > 32) & (_BYTES < 127) & ~_LETTER & ~_DIGIT & ~_PUNCTUATION


@dataclass(frozen=True)
class Factors:
    """Parameters.

    At most ``sample_rows`` labelled documents are learned from, those with the
    smallest hash of the id, and of these as many as have ``sample_features`` features
    together. Words are hashed to ``buckets`` features; statistics have ``bins``
    quantile bins; ``rank`` is the length of a feature's vector. The sample is passed
    ``epochs`` times in batches, more often if it takes fewer than ``least_steps`` so.
    """

    sample_rows: int = 12_000
    sample_features: int = 6_000_000
    buckets: int = 1 << 17
    bins: int = 12
    rank: int = 6
    epochs: int = 12
    batch: int = 48
    least_steps: int = 600
    rate: float = 0.08
    penalty: float = 2e-4
    threshold: float = 0.3
    seed: int = 11


@dataclass(frozen=True)
class Machine:
    """A fitted machine; features are buckets of words, then bins of each statistic."""

    bias: float
    weight: np.ndarray
    vectors: np.ndarray
    edges: np.ndarray  # of the bins: a row for each statistic

    def logits(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
        """Of sparse rows; the pairs by the identity of squared sums."""
        total = self.bias + np.bincount(row, self.weight[feature] * value, rows)
        for k in range(self.vectors.shape[1]):
            part = self.vectors[feature, k] * value
            sums = np.bincount(row, part, rows)
            total += 0.5 * (sums * sums - np.bincount(row, part * part, rows))
        return total


def held_out(ident: Column) -> Column:
    """Whether labels of a document must not be learned from: a fifth of all ids."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    params: Factors = Factors(),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    metadata: tuple[str, ...] = (),
) -> DataFrame:
    """A row per row of ``docs``: its id, ``held_out``, ``score`` and ``predicted``.

    ``labels`` has the id and 1 for good, 0 for poor. Labels of held-out ids are never
    read. A score depends on the text and on the numeric columns named in ``metadata``
    alone; it is the probability that the label is 1.

    * Null and empty texts are texts without words and have a score like any other. A
      null or NaN of metadata has a bin of its own.
    * Without labels to learn from every score is 0.5; with labels of one kind it is
      ``(good + 1) / (good + poor + 2)``.
    * A document with labels of both kinds counts as poor; null labels and null ids in
      ``labels`` are left out. Copies of a text count once in the sample, as poor if any
      is. Repeated rows are scored each.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column, *metadata)
    require_columns(labels, id_column, label_column)
    numbers = [F.coalesce(quoted(m).cast("double"), F.lit(float("nan"))) for m in metadata]
    rows = docs.select(
        quoted(id_column).alias("id"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
        F.array(*numbers).cast("array<double>").alias("metadata"),
    )
    machine = _fit(_sample(rows, labels, params, id_column, label_column), params, len(metadata))
    if isinstance(machine, float):
        scored = rows.select("id", F.lit(machine).alias("score"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast(machine)
        kind = dict(rows.dtypes)["id"]
        scored = rows.mapInArrow(
            lambda b: _scores(b, sent.value, params), f"id {kind}, logit double"
        ).select("id", (1 / (1 + F.exp(-F.col("logit")))).alias("score"))
    return scored.select(
        F.col("id").alias(id_column),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
    )


def _sample(
    rows: DataFrame, labels: DataFrame, params: Factors, id_column: str, label_column: str
) -> DataFrame:
    """Features and labels to learn from, in the order of ``place``."""
    known = labels.select(
        quoted(id_column).alias("label_id"), quoted(label_column).cast("int").alias("good")
    ).dropna()
    known = known.filter(~held_out(F.col("label_id")))
    chosen = (
        known.groupBy("label_id")
        .agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("label_id", F.lit(12)), "label_id")
        .limit(params.sample_rows)
    )
    # Bounded by sample_rows.
    learned = rows.join(F.broadcast(stored(chosen, "good-labels")), F.col("id") == F.col("label_id"))
    texts = learned.groupBy(F.sha2("text", 256).alias("digest")).agg(
        F.min(F.struct("good", "text", "metadata")).alias("one")
    )
    features = texts.select("digest", "one.text", "one.good", "one.metadata").mapInArrow(
        lambda b: _features(b, params),
        "place string, good int, words array<int>, amounts array<float>, numbers array<double>",
    )
    features = stored(features, "good-features")
    # A sum over at most sample_rows rows.
    so_far = F.sum(F.size("words") + F.size("numbers")).over(
        Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    )
    sums = features.select("place", so_far.alias("n")).filter(F.col("n") <= params.sample_features)
    return features.join(F.broadcast(sums.select("place")), "place", "left_semi")


# --- fitting, over the bounded sample ---------------------------------------


def _fit(sample: DataFrame, params: Factors, metadata: int) -> Machine | float:
    """The machine, or the score of all documents where there is nothing to tell apart."""
    found = sample.toArrow()
    order = np.argsort(found.column("place").to_numpy(zero_copy_only=False).astype(str))
    good = found.column("good").to_numpy()[order].astype(np.float64)
    if not len(good):
        return 0.5
    if good.min() == good.max():
        return float((good.sum() + 1) / (len(good) + 2))
    found = found.take(pa.array(order)).combine_chunks()
    statistics = len(STATISTICS) + metadata
    numbers = found.column("numbers").combine_chunks().flatten().to_numpy()
    numbers = numbers.reshape(-1, statistics)
    edges = np.stack([_edges(column, params.bins) for column in numbers.T])
    words = found.column("words").combine_chunks()
    row = np.repeat(np.arange(len(good)), words.value_lengths().to_numpy())
    row, feature, value = assembled(
        row,
        words.flatten().to_numpy().astype(np.int64),
        found.column("amounts").combine_chunks().flatten().to_numpy(),
        numbers,
        edges,
        params,
    )
    return _descend(row, feature, value, good, edges, params)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """What parts the bins of a statistic: quantiles, equal ones where values repeat."""
    known = values[~np.isnan(values)]
    if not len(known):
        return np.zeros(bins - 1)
    return np.quantile(known, np.arange(1, bins) / bins)


def assembled(row, words, amounts, numbers, edges, params: Factors):
    """Rows, features and values, sorted by row: words, then a bin for each statistic."""
    rows, statistics = numbers.shape
    bins = params.bins + 1  # the last one for unknown numbers
    bin_of = np.stack(
        [np.searchsorted(edges[s], numbers[:, s], side="right") for s in range(statistics)], axis=1
    ) if rows else np.empty((0, statistics), dtype=np.int64)
    bin_of = np.where(np.isnan(numbers), params.bins, bin_of)
    feature = params.buckets + np.arange(statistics) * bins + bin_of
    row = np.concatenate((row, np.repeat(np.arange(rows), statistics)))
    order = np.argsort(row, kind="stable")
    value = np.full(rows * statistics, 1 / np.sqrt(max(statistics, 1)), dtype=np.float32)
    return (
        row[order],
        np.concatenate((words, feature.ravel()))[order],
        np.concatenate((amounts, value))[order],
    )


def _descend(row, feature, value, good, edges, params: Factors) -> Machine:
    """Logistic loss by gradient steps over batches, scaled by past gradients (AdaGrad)."""
    draw = np.random.default_rng(params.seed)
    size = params.buckets + len(edges) * (params.bins + 1)
    share = np.clip(good.mean(), 1e-3, 1 - 1e-3)
    bias, weight = np.log(share / (1 - share)), np.zeros(size)
    vectors = draw.normal(0, 0.05, (size, params.rank))
    steps = [1e-8, np.full(size, 1e-8), np.full((size, params.rank), 1e-8)]
    first = np.searchsorted(row, np.arange(len(good) + 1))
    deal = draw.permutation(len(good))
    batches = []
    for low in range(0, len(good), params.batch):
        rows = np.sort(deal[low : low + params.batch])
        length = first[rows + 1] - first[rows]
        at = np.repeat(first[rows], length) + arrays.places(length)
        used, local = np.unique(feature[at], return_inverse=True)
        order = np.argsort(local, kind="stable")
        begins = np.searchsorted(local[order], np.arange(len(used)))
        batches.append((rows, np.repeat(np.arange(len(rows)), length), value[at], used, local, order, begins))
    for _ in range(max(params.epochs, -(-params.least_steps // len(batches)))):
        for rows, r, x, used, local, order, begins in batches:
            w, v = weight[used], vectors[used]
            parts = v[local] * x[:, None]
            starts = np.searchsorted(r, np.arange(len(rows)))
            sums = np.add.reduceat(parts, starts, axis=0)
            squares = np.add.reduceat(parts * parts, starts, axis=0)
            logit = bias + np.add.reduceat(w[local] * x, starts)
            logit += 0.5 * (sums * sums - squares).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - good[rows]) / len(rows)
            pull = (error[r] * x)[order]
            by_weight = np.add.reduceat(pull, begins) + params.penalty * w
            by_vector = np.add.reduceat(pull[:, None] * (sums[r] - parts)[order], begins, axis=0)
            by_vector += params.penalty * v
            steps[0] += error.sum() ** 2
            steps[1][used] += by_weight**2
            steps[2][used] += by_vector**2
            bias -= params.rate * error.sum() / np.sqrt(steps[0])
            weight[used] = w - params.rate * by_weight / np.sqrt(steps[1][used])
            vectors[used] = v - params.rate * by_vector / np.sqrt(steps[2][used])
    return Machine(float(bias), weight.astype(np.float32), vectors.astype(np.float32), edges)


# --- in tasks --------------------------------------------------------------


def described(column: pa.Array, buckets: int):
    """Row, bucket and value of the words of each text, and the statistics of the texts.

    A word's value is ``1 + ln`` of how often it occurs, scaled so that the squares of
    a text's values sum to 1.
    """
    data, offsets = arrays.texts_of(column)
    w = arrays.words(data, offsets)
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows), np.diff(w.first))
    code = row * buckets + (w.hash % np.uint64(buckets)).astype(np.int64)
    code, times = np.unique(code, return_counts=True)
    held = code // buckets
    value = 1 + np.log(times)
    value /= np.sqrt(np.maximum(np.bincount(held, value * value, rows), 1e-12))[held]
    most = np.zeros(rows)
    np.maximum.at(most, held, times)
    different = np.bincount(held, minlength=rows)
    return held, code % buckets, value.astype(np.float32), structure(data, offsets, w, row, different, most)


def structure(data, offsets, w: arrays.Words, row, different, most) -> np.ndarray:
    """The statistics of each text, a column for each of ``STATISTICS``."""
    rows = len(offsets) - 1
    size, words = np.diff(offsets), np.diff(w.first)

    def of_class(chosen: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(chosen[data]), offsets))

    ends = np.flatnonzero(data == _LINE_END)
    lines = np.diff(np.searchsorted(ends, offsets)) + (size > 0)
    again = np.zeros(len(w.hash), dtype=bool)
    again[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    letters = np.flatnonzero(_LETTER[data])
    bare = np.searchsorted(letters, w.end) == np.searchsorted(letters, w.start)
    # Lines that hold the start of a word.
    line_of = np.searchsorted(ends, w.start) + row
    begun = np.ones(len(row), dtype=bool)
    begun[1:] = line_of[1:] != line_of[:-1]
    full = np.bincount(row[begun], minlength=rows)
    count = np.maximum(words, 1)
    length = np.maximum(size, 1)
    return np.stack(
        [
            size,
            words,
            lines,
            words / np.maximum(lines, 1),
            size / count,
            different / count,
            most / count,
            np.bincount(row, again, rows) / count,
            of_class(_UPPER) / length,
            of_class(_DIGIT) / length,
            of_class(_PUNCTUATION) / length,
            of_class(_SYMBOL) / length,
            of_class(_BEYOND) / length,
            np.bincount(row, bare, rows) / count,
            (lines - full) / np.maximum(lines, 1),
        ],
        axis=1,
    ).astype(np.float64)


def _numbers(statistics: np.ndarray, metadata: pa.Array) -> np.ndarray:
    """Statistics and metadata side by side."""
    values = metadata.flatten().to_numpy(zero_copy_only=False)
    return np.concatenate((statistics, values.reshape(len(statistics), -1)), axis=1)


def _features(batches: Iterator[pa.RecordBatch], params: Factors) -> Iterator[pa.RecordBatch]:
    for batch in arrays.portions(batches, 1):
        row, word, value, statistics = described(batch.column(1), params.buckets)
        numbers = _numbers(statistics, batch.column(3))
        ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        wide = np.arange(batch.num_rows + 1, dtype=np.int32) * numbers.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(word.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(value)),
                pa.ListArray.from_arrays(pa.array(wide), pa.array(numbers.ravel())),
            ],
            ["place", "good", "words", "amounts", "numbers"],
        )


def _scores(
    batches: Iterator[pa.RecordBatch], machine: Machine, params: Factors
) -> Iterator[pa.RecordBatch]:
    for batch in arrays.portions(batches, 1):
        row, word, value, statistics = described(batch.column(1), params.buckets)
        numbers = _numbers(statistics, batch.column(2))
        row, feature, value = assembled(row, word, value, numbers, machine.edges, params)
        logit = machine.logits(row, feature, value, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(logit)], ["id", "logit"])

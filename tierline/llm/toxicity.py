"""Toxicity by class-conditional Kneser-Ney models of word pairs.

One model is counted over toxic documents, one over ordinary ones. Each is an
interpolated Kneser-Ney model: pairs are discounted and back off to how many
different words a word follows in the class, and that backs off to the same count
over **all** documents, which both models share. That count is exact for every word
whose shared probability moves a score; all pairs together are counted to 0.8 %. A word
or pair keeps counts of its own class only where the classes differ by a large factor.
Rare expressions, and words that are about as common in both classes, have the shared
probability in both models and so do not move the comparison; else the mix of
languages and subjects in a few labelled documents would outweigh a few words.

The score of a document is the mean of log p(word | toxic) - log p(word |
ordinary) over its words, mapped to (0, 1) by a logistic curve. The curve is fitted
on documents that the models which score them have not counted (two folds).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored

#: Words are runs of ASCII letters and digits and of all bytes of other characters.
_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[48:58] = _SEPARATOR[65:91] = _SEPARATOR[97:123] = _SEPARATOR[128:] = False

_FOLDS = 2


@dataclass(frozen=True)
class Toxicity:
    """Parameters.

    ``class_rows`` labelled documents of each class and fold are counted at most,
    those with the smallest hash of the id; copies count once, and a pair once
    for each document. The models know every word and pair of these documents; other
    words have no class counts. ``factor`` is how far the rates of the classes must
    be apart, with one expected occurrence added. ``discount`` is that of Kneser
    and Ney.
    """

    class_rows: int = 5_000
    factor: float = 16.0
    discount: float = 0.75
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    """Log ratio of a word, and what it is more after a certain other word.

    A pair without counts of its own has the probability of its word: the share
    that its first word leaves for backing off is taken as equal in both classes.
    """

    vocabulary: np.ndarray  # sorted word hashes; place 0 for all others, the last for a text's start
    word: np.ndarray
    pairs: np.ndarray  # sorted h * size + w
    extra: np.ndarray


def held_out(ident: Column) -> Column:
    """Whether labels of a document must not be learned from: a third of all ids."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    params: Toxicity = Toxicity(),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> DataFrame:
    """A row per row of ``docs``: its id, ``held_out``, ``score`` and ``predicted``.

    ``labels`` has the id and 1 for toxic, 0 for ordinary. Labels of held-out ids
    are never read. Text alone decides a score.

    * Empty, blank and null texts have a mean of 0 and the score of that.
    * Without labels of both classes every score is 0.
    * A document with labels of both kinds counts as toxic; null labels and null
      ids in ``labels`` are left out. Repeated rows are counted and scored each.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    require_columns(labels, id_column, label_column)
    rows = docs.select(
        quoted(id_column).alias("id"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
    )
    sample = _sample(labels, params, id_column, label_column)
    # Bounded by class_rows; only these texts are shuffled or kept.
    learned = rows.join(F.broadcast(sample), rows["id"] == sample["label_id"])
    first = learned.groupBy(F.sha2("text", 256)).agg(
        F.min(F.struct("label_id", "toxic", "fold", "text")).alias("one")
    )
    learned = stored(first.select("one.text", "one.toxic", "one.fold"), "toxic-sample")
    fitted = _fit(learned, rows.select("text"), params)
    if fitted is None:
        score = F.lit(0.0)
        scored = rows.select("id", score.alias("score"))
    else:
        model, slope, shift = fitted
        sent = docs.sparkSession.sparkContext.broadcast(model)
        means = rows.withColumn("held_out", held_out(F.col("id"))).select("id", "text")
        kind = dict(rows.dtypes)["id"]
        scored = means.mapInArrow(
            lambda b: _means(b, sent.value), f"id {kind}, mean double"
        ).select("id", (1 / (1 + F.exp(-(F.col("mean") * slope + shift)))).alias("score"))
    return scored.select(
        F.col("id").alias(id_column),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
    )


def _sample(labels: DataFrame, params: Toxicity, id_column: str, label_column: str) -> DataFrame:
    """Ids to learn from, with class and fold."""
    known = labels.select(
        quoted(id_column).alias("label_id"), quoted(label_column).cast("int").alias("toxic")
    ).dropna()
    known = known.filter(~held_out(F.col("label_id")))
    known = known.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    fold = F.pmod(F.xxhash64("label_id"), F.lit(_FOLDS)).cast("int")
    parts = [
        known.filter((F.col("toxic") == kind) & (fold == f))
        .orderBy(F.xxhash64("label_id", F.lit(7)), "label_id")
        .limit(params.class_rows)
        .select("label_id", F.lit(kind).alias("toxic"), F.lit(f).alias("fold"))
        for kind in (0, 1)
        for f in range(_FOLDS)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return stored(union, "toxic-labels")


def _fit(learned: DataFrame, texts: DataFrame, params: Toxicity):
    """The model of all folds, and slope and shift of the curve."""
    by_class = {r["toxic"]: r["n"] for r in learned.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not (by_class.get(0) and by_class.get(1)):
        return None
    vocabulary = _vocabulary(learned)
    context = learned.sparkSession.sparkContext
    words = context.broadcast(vocabulary)
    counts = learned.select("text", "toxic", "fold").mapInArrow(
        lambda b: _pair_counts(b, words.value), "toxic int, fold int, pair long, n long"
    )
    counts = stored(counts.groupBy("toxic", "fold", "pair").agg(F.sum("n").alias("n")), "toxic-pairs")
    # Each fold is scored by the model of the others.
    tables = [_tables(counts, vocabulary, params)] + [
        _tables(counts.filter(F.col("fold") != fold), vocabulary, params) for fold in range(_FOLDS)
    ]
    # Shared by both classes and gathered from every document: how many words come before a
    # word, for those whose number moves a score, and how many pairs there are in all.
    moving = np.unique(np.concatenate([t.moving for t in tables if t is not None]))
    wanted = context.broadcast((vocabulary, moving))
    pairs = texts.mapInArrow(lambda b: _distinct_pairs(b, *wanted.value), "w int, pair long")
    follows = pairs.distinct().groupBy("w").agg(F.count(F.lit(1)).alias("n"), F.max("pair").alias("rank"))
    found = follows.toArrow()
    w, n, rank = (found.column(k).to_numpy() for k in range(3))
    shared, registers = np.zeros(_size(vocabulary)), np.zeros(_REGISTERS)
    shared[w[w >= 0]] = n[w >= 0]
    registers[-1 - w[w < 0]] = rank[w < 0]
    base = (shared + 0.5) / (estimated(registers) + 0.5 * _size(vocabulary))
    whole, *others = [t and _model(t, base, vocabulary, params) for t in tables]
    means, kinds = [], []
    for fold, other in enumerate(others):
        if other is None:
            continue
        sent = context.broadcast(other)
        found = (
            learned.filter(F.col("fold") == fold)
            .select("toxic", "text")
            .mapInArrow(lambda b: _means(b, sent.value), "toxic int, mean double")
            .toArrow()
        )
        means.append(found.column("mean").to_numpy())
        kinds.append(found.column("toxic").to_numpy())
    slope, shift = _curve(np.concatenate(means), np.concatenate(kinds)) if means else (1.0, 0.0)
    return whole, slope, shift


def _vocabulary(learned: DataFrame) -> np.ndarray:
    """Hashes of all words of the documents to learn from."""
    found = learned.select("text").mapInArrow(_distinct_words, "word long").distinct()
    return np.sort(found.toArrow().column(0).to_numpy().view(np.uint64))


def _size(vocabulary: np.ndarray) -> int:
    """Places: other words, those of the vocabulary, the start of a text."""
    return len(vocabulary) + 2


@dataclass(frozen=True)
class Tables:
    """Counts of both classes: by first word, by second word, and of pairs far apart."""

    first: np.ndarray
    second: np.ndarray
    own: np.ndarray  # words that keep counts of their class
    pair: np.ndarray
    n: list[np.ndarray]

    @property
    def moving(self) -> np.ndarray:
        """Places whose shared probability moves a score; that of others cancels out."""
        return np.union1d(np.flatnonzero(self.own), self.pair % len(self.own))


def _tables(counts: DataFrame, vocabulary: np.ndarray, params: Toxicity) -> Tables | None:
    size = _size(vocabulary)
    both = counts.groupBy("pair").agg(
        *[F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)]
    )
    both = both.select(
        F.expr(f"cast(pair div {size} as int)").alias("h"),
        F.expr(f"cast(pair % {size} as int)").alias("w"),
        "pair",
        "n0",
        "n1",
    )
    sums = [F.sum("n0"), F.sum("n1"), F.count_if(F.col("n0") > 0), F.count_if(F.col("n1") > 0)]
    first = _table(both.groupBy("h").agg(*sums), size)
    second = _table(both.groupBy("w").agg(*sums), size)
    total = first[:2].sum(axis=1)
    if not total.all():
        return None
    ratio = [(F.col(f"n{k}") + float(2 * total[k] / total.sum())) / float(total[k]) for k in (0, 1)]
    far = F.abs(F.log(ratio[1]) - F.log(ratio[0]))
    pairs = (
        both.filter(far > float(np.log(params.factor)))
        .select("pair", "n0", "n1")
        .toArrow()
    )
    pair, *n = (pairs.column(k).to_numpy() for k in range(3))
    order = np.argsort(pair)
    own = _apart(second[0], second[1], total, params.factor)
    return Tables(first, second, own, pair[order], [x[order] for x in n])


def _model(t: Tables, base: np.ndarray, vocabulary: np.ndarray, params: Toxicity) -> Model:
    """Kneser-Ney models of both classes, as one table of log ratios."""
    size, d = _size(vocabulary), params.discount
    after, word = [], []
    for k in (0, 1):
        seen, fanout, follows = t.first[k], t.first[2 + k], t.second[2 + k]
        lower = np.maximum(follows - d, 0) + d * np.count_nonzero(follows) * base
        word.append(np.where(t.own, lower / follows.sum(), base))
        # A word that is never the first of a pair backs off with all its weight.
        after.append(np.divide(d * fanout, seen, out=np.ones(size), where=seen > 0))
    h, w = t.pair // size, t.pair % size
    extra = np.zeros(len(t.pair))
    for k, sign in ((0, -1), (1, 1)):
        seen = t.first[k][h]
        direct = np.divide(np.maximum(t.n[k] - d, 0), seen, out=np.zeros(len(h)), where=seen > 0)
        extra += sign * np.log((direct + after[k][h] * word[k][w]) / word[k][w])
    return _moving(Model(vocabulary, np.log(word[1]) - np.log(word[0]), t.pair, extra))


#: Registers of the count of distinct pairs; its standard error is 1.04 / sqrt of them, 0.8 %.
_REGISTERS = 1 << 14


def _ranks(hashes: np.ndarray) -> np.ndarray:
    """For each register the longest run of zeros, and one, among its hashes; 0 without any."""
    registers = np.zeros(_REGISTERS, dtype=np.int64)
    rest = (hashes >> np.uint64(14)).astype(np.float64)
    rank = np.where(rest > 0, 50 - np.floor(np.log2(np.maximum(rest, 1))), 51).astype(np.int64)
    np.maximum.at(registers, (hashes & np.uint64(_REGISTERS - 1)).astype(np.int64), rank)
    return registers


def estimated(registers: np.ndarray) -> float:
    """How many different hashes the registers have seen (HyperLogLog)."""
    m = len(registers)
    found = 0.7213 / (1 + 1.079 / m) * m * m / np.sum(2.0 ** -registers)
    empty = np.count_nonzero(registers == 0)
    return float(m * np.log(m / empty)) if found <= 2.5 * m and empty else float(found)


def _moving(model: Model) -> Model:
    """The same scores, without the words that add nothing: no ratio and in no pair."""
    size = _size(model.vocabulary)
    h, w = model.pairs // size, model.pairs % size
    stays = model.word != 0
    stays[h] = stays[w] = True
    stays[[0, -1]] = True
    place = np.cumsum(stays) - 1
    kept = model.vocabulary[stays[1:-1]]
    return Model(kept, model.word[stays], place[h] * _size(kept) + place[w], model.extra)


def _table(grouped: DataFrame, size: int) -> np.ndarray:
    """The columns after the first, by the place that the first one gives."""
    found = grouped.toArrow()
    result = np.zeros((found.num_columns - 1, size))
    for k in range(1, found.num_columns):
        result[k - 1, found.column(0).to_numpy()] = found.column(k).to_numpy()
    return result


def _apart(ordinary, toxic, total, factor: float) -> np.ndarray:
    """Where the rates of the classes differ by ``factor``, one expected count added."""
    added = 2 * total / total.sum()
    rates = [(n + a) / t for n, a, t in zip((ordinary, toxic), added, total)]
    return np.abs(np.log(rates[1]) - np.log(rates[0])) > np.log(factor)


def _curve(means: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve; both classes weigh the same.

    Ridge regression of the standardised means by Newton's method; the penalty
    keeps the slope finite where the classes are apart.
    """
    centre, scale = means.mean(), means.std() or 1.0
    x = np.stack([(means - centre) / scale, np.ones(len(means))], axis=1)
    weight = np.where(toxic == 1, 0.5 / max(toxic.sum(), 1), 0.5 / max((toxic == 0).sum(), 1))
    weight *= len(means)
    beta, penalty = np.zeros(2), np.diag([1e-3 * len(means), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (toxic - p)) - penalty @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * centre / scale)


# --- in tasks --------------------------------------------------------------


def _words(column: pa.Array) -> arrays.Words:
    data, offsets = arrays.texts_of(column)
    data = data.copy()
    # Latin-1 capitals, C3 80 to C3 9E without the sign C3 97, to lower case.
    capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[1:][capital] += 0x20
    return arrays.words(data, offsets, fold=arrays.LOWER, separator=_SEPARATOR)


def _known(words: arrays.Words, vocabulary: np.ndarray) -> np.ndarray:
    """Place in the vocabulary from 1 on, 0 for other words."""
    if not len(vocabulary):
        return np.zeros(len(words.hash), dtype=np.int64)
    at = np.searchsorted(vocabulary, words.hash)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == words.hash, at + 1, 0)


def _pairs(words: arrays.Words, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each word with the one before it, and which row it is in.

    The first word of a text comes after the place of a start.
    """
    known = _known(words, vocabulary)
    before = np.concatenate(([0], known[:-1])) if len(known) else known
    before[words.first[:-1][np.diff(words.first) > 0]] = len(vocabulary) + 1
    row = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    return before * _size(vocabulary) + known, row


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of a document once."""
    for batch in arrays.portions(batches, 0):
        w = _words(batch.column(0))
        row = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
        order = np.lexsort((w.hash, row))
        row, hashes = row[order], w.hash[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(hashes[new].view(np.int64))], ["word"])


def _pair_counts(
    batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for batch in arrays.portions(batches, 0):
        codes, row = _pairs(_words(batch.column(0)), vocabulary)
        order = np.lexsort((codes, row))  # each pair of a document once
        codes, row = codes[order], row[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (codes[1:] != codes[:-1])
        codes, row = codes[new], row[new]
        toxic, fold = (batch.column(k).to_numpy() for k in (1, 2))
        for kind in (0, 1):
            for f in range(_FOLDS):
                chosen = ((toxic == kind) & (fold == f))[row]
                pair, n = np.unique(codes[chosen], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(pair), kind, dtype=np.int32)),
                        pa.array(np.full(len(pair), f, dtype=np.int32)),
                        pa.array(pair),
                        pa.array(n),
                    ],
                    ["toxic", "fold", "pair", "n"],
                )


def _distinct_pairs(
    batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray, moving: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Each pair of words by its hash with the place of the second, for the places wanted.

    All pairs are in the registers, which follow as rows with negative places.
    """
    registers = np.zeros(_REGISTERS, dtype=np.int64)
    for batch in arrays.portions(batches, 0):
        words = _words(batch.column(0))
        before = np.concatenate((np.zeros(1, np.uint64), words.hash))[:-1]
        before[words.first[:-1][np.diff(words.first) > 0]] = 0
        pair = arrays.mixed(arrays.mixed(before + np.uint64(1)) + words.hash)
        registers = np.maximum(registers, _ranks(pair))
        w = _known(words, vocabulary)
        wanted = np.isin(w, moving)
        pair, at = np.unique(pair[wanted], return_index=True)
        w = w[wanted][at].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(pair.view(np.int64))], ["w", "pair"])
    seen = np.flatnonzero(registers)
    places = (-1 - seen).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(registers[seen])], ["w", "pair"])


def _means(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """The first column, and the mean log ratio of the words of the second."""
    size = _size(model.vocabulary)
    for batch in batches:
        text = 1
        for part in arrays.portions(iter([batch]), text):
            words = _words(part.column(text))
            codes, row = _pairs(words, model.vocabulary)
            value = model.word[codes % size]
            if len(model.pairs):
                at = np.searchsorted(model.pairs, codes)
                at[at == len(model.pairs)] = 0
                value = value + np.where(model.pairs[at] == codes, model.extra[at], 0.0)
            total = np.bincount(row, weights=value, minlength=part.num_rows)
            mean = total / np.maximum(np.diff(words.first), 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(mean)], [part.schema.names[0], "mean"]
            )

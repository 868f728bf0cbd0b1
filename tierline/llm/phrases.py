"""Collocated phrases, mined by partitions (SON) and counted exactly.

A phrase that reaches its support in a language reaches the same share of it in at
least one of any shards the texts are dealt to. So:

1. Each shard is mined completely at its proportionally lowered support, one length
   after another: words, then pairs of words that passed, then what consists of such
   pairs. A shard is a group of the tasks that read texts and is counted by all of
   them, by hashes; no task holds one.
2. What is frequent in any shard, and can reach the support with the most that the other
   shards may have of it, is united into a filter of fixed size.
3. The phrases that pass are counted over all texts, by their words and not by hashes.

The filter and the hashes can let too much through, never too little, and step 3 counts
exactly what it is given; so phrases, counts and order are exact at every size. Where
the filter fills up, more rows are shuffled and nothing else changes.

A phrase scores by its weakest cut: twice its count over those of its two parts. One
that is nearly always part of a longer candidate is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored

#: Bytes that end a piece of a text, and those that part words.
_END = np.zeros(256, dtype=bool)
_END[list(b".,;:!?\n\x0b\x0c\r")] = True
_SEPARATOR = _END.copy()
_SEPARATOR[[9, 32]] = True

#: Parts of a language that are ranked on their own.
_PARTS = 64

#: Bytes of text, and keys to look up, that a task works on at once.
_PORTION, _LOOKED_UP = 1 << 21, 1 << 17

_HASHED = "shard int, key long, n long"


@dataclass(frozen=True)
class Phrases:
    """Parameters.

    Phrases have 2 to ``longest`` words and occur ``support`` times in their language.
    Of ``shards`` shards, each is mined with its part of the support, rounded up. The
    filter has ``2**filter_bits`` bits. A phrase with ``inside`` hundredths of its
    occurrences in a longer candidate is dropped; of the rest, ``most`` are returned
    for a language.
    """

    longest: int = 4
    support: int = 30
    shards: int = 8
    filter_bits: int = 26
    inside: int = 80
    most: int = 2_000

    def __post_init__(self):
        if not (self.shards >= 1 and 2 <= self.longest <= 8):
            raise ValueError("there is at least one shard, and phrases have 2 to 8 words")
        if not (self.support >= 1 and 6 <= self.filter_bits <= 32):
            raise ValueError("the support is positive, and the filter has 2**6 to 2**32 bits")


def collocations(
    docs: DataFrame,
    params: Phrases = Phrases(),
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase`` and its counts.

    A text is split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks and tabs
    into words; A-Z is lower-cased. ``a`` counts all occurrences of the phrase within
    pieces, overlapping ones too, ``n`` all words of the language. Cut after its first
    words, a phrase scores ``2000000 a div (l + r)`` with ``l`` and ``r`` the counts of
    both parts; the lowest cut counts, of equal ones the first. Phrases are ranked by
    score, then ``a``, then their bytes.

    * A null text is empty; a null language is ``und``.
    * Repeated rows count each. Whole texts are read.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, text_column, lang_column)
    rows = docs.select(
        F.coalesce(quoted(lang_column).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
    )
    counted = frequent(rows, params)
    phrases = counted.filter("words > 0 AND a >= {}".format(int(params.support)))
    sizes = counted.filter("words = 0").select("lang", F.col("a").alias("n"))
    return _best(phrases, sizes, params)


def frequent(rows: DataFrame, params: Phrases) -> DataFrame:
    """Counts of all words and phrases that can be frequent: ``lang``, ``words``, ``phrase``, ``a``.

    The row with no ``words`` has the number of all words of a language.
    """
    spark = rows.sparkSession
    # A phrase with the support in all has this much in one of the shards at least.
    local = -(-params.support // params.shards)
    passed = np.zeros(max(1, (1 << params.filter_bits) // 64), dtype=np.uint64)
    for lengths in _passes(params.longest):
        known = spark.sparkContext.broadcast(passed)
        mined = rows.mapInArrow(lambda b: _hashed(b, lengths, known.value, params), _HASHED)  # noqa: B023
        counts = mined.groupBy("shard", "key").agg(F.sum("n").alias("n"))
        # Shards in which a phrase is rare have less than the local support of it each.
        rest = (params.shards - F.count(F.lit(1))) * (local - 1)
        candidates = (
            counts.filter(F.col("n") >= local)
            .groupBy("key")
            .agg((F.sum("n") + rest).alias("most"))
            .filter(F.col("most") >= params.support)
        )
        passed = _united(passed, candidates, params)
        known.unpersist()
    known = spark.sparkContext.broadcast(passed)
    exact = rows.mapInArrow(
        lambda b: _counted(b, known.value, params), "lang string, words int, phrase string, n long"
    )
    exact = exact.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("a"))
    return stored(exact.filter(f"words = 0 OR a >= {int(params.support)}"), "phrases")


def _passes(longest: int) -> list[tuple[int, ...]]:
    """Lengths that are mined together: what needs pairs follows them in one pass."""
    rest = tuple(range(3, longest + 1))
    return [(1,), (2,)] + ([rest] if rest else [])


def _united(passed: np.ndarray, candidates: DataFrame, params: Phrases) -> np.ndarray:
    """The filter with the bits of these keys: two of each, from either half."""
    mask = (1 << params.filter_bits) - 1
    at = F.explode(
        F.array(
            F.expr(f"key & {mask}L"),
            F.expr(f"shiftrightunsigned(key, 32) & {mask}L"),
        )
    )
    bits = candidates.select(at.alias("at")).select(
        F.expr("cast(shiftright(at, 6) AS int)").alias("word"),
        F.expr("shiftleft(1L, cast(at & 63 AS int))").alias("bit"),
    )
    words = bits.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    passed = passed.copy()
    place = words.column(0).to_numpy()
    passed[place] |= words.column(1).to_numpy().view(np.uint64)
    return passed


def _best(phrases: DataFrame, sizes: DataFrame, params: Phrases) -> DataFrame:
    """Candidates with their weakest cut, without those inside of longer ones, ranked."""
    candidates = phrases.filter("words > 1")
    # Every part of a frequent phrase is frequent, so all of them are in the table.
    cuts = candidates.select(
        "lang",
        "phrase",
        "a",
        F.split("phrase", " ").alias("each"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.expr("slice(each, 1, k)"), " ").alias("head"),
        F.array_join(F.expr("slice(each, k + 1, size(each) - k)"), " ").alias("tail"),
    )
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    # Stored, so that both sides of the join are shuffled for it and a word that begins
    # very many phrases can be split.
    cuts = stored(cuts.join(heads, ["lang", "head"]), "phrase-heads").join(tails, ["lang", "tail"])
    score = F.expr("(2000000 * cast(a AS decimal(20,0))) div (cast(l AS decimal(20,0)) + r)")
    scored = (
        cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min("cut").alias("cut"))
    )
    parts = F.expr(
        """flatten(transform(sequence(2, words - 1), size ->
             transform(sequence(1, words - size + 1), at ->
               array_join(slice(split(phrase, ' '), at, size), ' '))))"""
    )
    longer = (
        candidates.filter("words > 2")
        .select("lang", F.explode(parts).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    staying = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.expr(
            f"longer IS NULL OR 100 * cast(longer AS decimal(20,0)) < {int(params.inside)} * cast(a AS decimal(20,0))"
        )
    )
    order = (F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    # The best of parts of a language first, so that one task never meets all of a large one.
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    in_lang = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = staying.withColumn("rank", in_part).filter(F.col("rank") <= params.most)
    ranked = ranked.withColumn("rank", in_lang).filter(F.col("rank") <= params.most)
    return ranked.join(sizes, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").alias("score"),
    )


# --- in tasks --------------------------------------------------------------


@dataclass
class _Text:
    """Words of a batch: hashes, whether the next one follows in the piece, language codes."""

    data: np.ndarray
    words: arrays.Words
    next: np.ndarray
    lang: np.ndarray  # of each word, a place in names
    names: list[str]


def _read(batch: pa.RecordBatch) -> _Text:
    data, offsets = arrays.texts_of(batch.column(1))
    w = arrays.words(data, offsets, fold=arrays.LOWER, separator=_SEPARATOR)
    codes = batch.column(0).dictionary_encode()
    row = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
    piece = np.searchsorted(np.flatnonzero(_END[data]), w.start)
    follows = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    lang = codes.indices.to_numpy()[row]
    return _Text(data, w, follows, lang, codes.dictionary.to_pylist())


def _language_keys(names: list[str]) -> np.ndarray:
    digests = [hashlib.blake2b(x.encode(), digest_size=8).digest() for x in names]
    return np.array([int.from_bytes(d, "little") for d in digests], dtype=np.uint64)


def _may_pass(passed: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    found = np.ones(len(keys), dtype=bool)
    for low in range(0, len(keys), _LOOKED_UP):
        part = keys[low : low + _LOOKED_UP]
        for at in (part & mask, (part >> np.uint64(32)) & mask):
            word = passed[(at >> np.uint64(6)).astype(np.int64)]
            found[low : low + _LOOKED_UP] &= (word >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def _grams(text: _Text, languages: np.ndarray, passed: np.ndarray, longest: int, bits: int):
    """For each length: keys of the phrases that begin at each word, and which may be frequent.

    A pair may be frequent if both words passed the filter, and what is longer if all its
    pairs did; its own key has not been looked up.
    """
    word = arrays.mixed(text.words.hash + languages[text.lang])
    yield 1, word, np.ones(len(word), dtype=bool)
    if longest == 1 or len(word) < 2:
        return
    single = _may_pass(passed, word, bits)
    key, good = _longer(word, word, 2), single[:-1] & single[1:] & text.next
    yield 2, key, good
    if longest == 2:
        return
    pair = np.flatnonzero(good)
    pairs = np.zeros(len(key), dtype=bool)
    pairs[pair] = _may_pass(passed, key[pair], bits)
    good = pairs
    for length in range(3, min(longest, len(word)) + 1):
        key, good = _longer(key, word, length), good[:-1] & pairs[length - 2 :]
        yield length, key, good


def _longer(key: np.ndarray, word: np.ndarray, length: int) -> np.ndarray:
    """Keys of phrases with one more word."""
    return arrays.mixed(key[: len(word) - length + 1] * np.uint64(0x9E3779B97F4A7C15) + word[length - 1 :])


def _hashed(
    batches: Iterator[pa.RecordBatch], lengths: tuple[int, ...], passed: np.ndarray, params: Phrases
) -> Iterator[pa.RecordBatch]:
    """Keys of phrases of these lengths, with their counts in the shard of this task."""
    shard = TaskContext.get().partitionId() % params.shards
    for batch in arrays.portions(batches, 1, _PORTION):
        text = _read(batch)
        languages = _language_keys(text.names)
        for length, key, good in _grams(text, languages, passed, lengths[-1], params.filter_bits):
            if length in lengths:
                found, n = np.unique(key[good], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(found), shard, dtype=np.int32)),
                        pa.array(found.view(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["shard", "key", "n"],
                )


def _counted(
    batches: Iterator[pa.RecordBatch], passed: np.ndarray, params: Phrases
) -> Iterator[pa.RecordBatch]:
    """Words and phrases that pass the filter, as strings, with their counts."""
    for batch in arrays.portions(batches, 1, _PORTION):
        text = _read(batch)
        languages = _language_keys(text.names)
        names = pa.array(text.names, pa.string())
        total = np.bincount(text.lang, minlength=len(text.names))
        yield _counted_rows(names, 0, pa.nulls(len(names), pa.string()), total)
        ids = _word_ids(text)
        many = int(ids.max(initial=0)) + 1
        for length, key, good in _grams(text, languages, passed, params.longest, params.filter_bits):
            at = np.flatnonzero(good)
            at = at[_may_pass(passed, key[at], params.filter_bits)]
            same = text.lang[at].astype(np.int64) * many + ids[at]  # equal words of a language
            for k in range(1, length):
                # Equal phrases: equal without their last word, and in that.
                same = _numbered(same) * many + ids[at + k]
            _, first, n = np.unique(same, return_index=True, return_counts=True)
            at = at[first]
            yield _counted_rows(names.take(pa.array(text.lang[at])), length, _strings(text, at, length), n)


def _numbered(values: np.ndarray) -> np.ndarray:
    """Equal values as equal numbers from 0 on."""
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def _counted_rows(langs: pa.Array, length: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [langs, pa.array(np.full(len(n), length, dtype=np.int32)), phrases, pa.array(n.astype(np.int64))],
        ["lang", "words", "phrase", "n"],
    )


def _word_ids(text: _Text) -> np.ndarray:
    """Numbers of words that are equal in their bytes."""
    w = text.words
    _, first, ids = np.unique(w.hash, return_index=True, return_inverse=True)
    length, model = w.end - w.start, first[ids]
    if (length == length[model]).all():
        for low in range(0, len(ids), 1 << 18):  # few bytes are compared at once
            part = slice(low, low + (1 << 18))
            within = arrays.places(length[part])
            own = text.data[np.repeat(w.start[part], length[part]) + within]
            other = text.data[np.repeat(w.start[model[part]], length[part]) + within]
            if (arrays.LOWER[own] != arrays.LOWER[other]).any():
                break
        else:
            return ids.astype(np.int64)
    # Two words have one hash: number them by what they are.
    lower, seen = arrays.LOWER[text.data].tobytes(), {}
    words = (lower[a:b] for a, b in zip(w.start.tolist(), w.end.tolist()))
    return np.array([seen.setdefault(x, len(seen)) for x in words], dtype=np.int64)


def _strings(text: _Text, at: np.ndarray, length: int) -> pa.Array:
    """Phrases of ``length`` words from these words on, joined by one space."""
    word = (at[:, None] + np.arange(length)).ravel()
    start, size = text.words.start[word], text.words.end[word] - text.words.start[word]
    last = np.tile(np.arange(length) == length - 1, len(at))
    wide = size + ~last
    source = np.repeat(start, wide) + arrays.places(wide)
    letters = arrays.LOWER[text.data[np.minimum(source, max(len(text.data) - 1, 0))]]
    ends = np.cumsum(wide)
    letters[ends[~last] - 1] = 32
    offsets = np.concatenate(([0], ends[length - 1 :: length])).astype(np.int64)
    held = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(letters))
    return held.cast(pa.string())

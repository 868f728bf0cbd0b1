"""Quality rules: a hashed n-gram log-likelihood ratio, and a few plain rules.

Words and pairs of neighbouring words are hashed to a fixed number of buckets.
Two multinomials over the buckets are compared: one of a trusted target (documents
labelled as good), one of the raw corpus (all documents). The score of a document
is the mean over its n-grams of log p(target) - log p(raw), so it does not grow
with the length, and one fixed threshold decides every document.

All of it is DataFrame functions. The raw counts cover every document; what goes
to the driver is one count per bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import SPACE, let, once, quoted, require_columns, words

#: The columns that the rules add.
ADDED = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "score",
    "kept",
)

#: Bits of the filter of trusted ids.
FILTER_BITS = 1 << 26

#: Words of a window that is looked for twice in a text.
WINDOW = 8


@dataclass(frozen=True)
class QualityRules:
    """Parameters. ``trusted_rows`` takes that many trusted documents alone; None all."""

    buckets: int = 65_536
    prior: float = 50.0
    trusted_rows: int | None = None
    threshold: float = -0.08
    least_words: int = 20
    most_repeated: int = 30  # per cent of the words


def quality(
    docs: DataFrame,
    trusted: DataFrame,
    params: QualityRules = QualityRules(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All rows and columns of ``docs`` with counts, score and verdict.

    ``trusted`` has the ids of trusted documents in ``id_column``; all are used, or the
    ``trusted_rows`` with the smallest hash of the id. Added columns, which replace
    any of the same name: ``n_words``, ``word_chars`` (code points in words),
    ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an earlier
    line), ``n_repeat_words`` (words in windows of eight that occur twice or
    more), ``base_failed``, ``score``, ``kept``.

    * A null, empty or blank text has no words: base failed, score 0.
    * Without trusted documents every score is 0 and only the base rules decide.
    * Repeated rows are counted and judged each; a null id is never trusted.
    * An empty table gives an empty result.
    """
    require_columns(docs, id_column, text_column)
    require_columns(trusted, id_column)
    ratios = log_ratios(docs, trusted, params, id_column, text_column)
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    columns = [c for c in docs.columns if c not in ADDED]
    row = F.struct(*[quoted(c) for c in columns]).alias("__doc")
    measured = once(docs, [row], _measures(quoted(text_column), table, params.buckets))
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < params.least_words) | (repeated * 100 > n * params.most_repeated)
    kept = ~failed & (F.col("score") >= params.threshold)
    return measured.select(
        *[F.col("__doc")[c].alias(c) for c in columns],
        *ADDED[:5],
        failed.alias("base_failed"),
        "score",
        kept.alias("kept"),
    )


def log_ratios(docs, trusted, params, id_column="doc_id", text_column="text") -> list[float]:
    """log p(target) - log p(raw) of each bucket, to six decimals.

    Each bucket has ``prior`` occurrences more in the raw corpus, and as many in
    the target as the trusted share of all n-grams gives. So a bucket that was seen
    a few times says little, in whichever documents that was, and the n-grams of a
    trusted document are not favoured for being its own.
    """
    ids = trusted.select(quoted(id_column).alias("__trusted")).dropna().distinct()
    if params.trusted_rows is not None:
        ids = ids.orderBy(F.xxhash64("__trusted"), "__trusted").limit(params.trusted_rows)
    rows = _with_trusted(docs.select(quoted(id_column), quoted(text_column)), ids, id_column)
    grams = let(_hashed(words(quoted(text_column))), lambda h: _grams(h, _paired(h, 1)))
    # An outer generator: for an inner one the planner adds a filter on the grams.
    counted = rows.select(
        F.col("__trusted").isNotNull().cast("long").alias("trusted"),
        F.explode_outer(grams).alias("gram"),
    ).filter(F.col("gram").isNotNull())
    bucket = F.pmod(F.col("gram"), F.lit(params.buckets)).cast("int")
    counts = (
        counted.groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
        .collect()  # one row for each bucket
    )
    raw, target = [0] * params.buckets, [0] * params.buckets
    for row in counts:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    share = sum(target) / max(sum(raw), 1)
    if not share:
        return [0.0] * params.buckets
    prior = params.prior
    return [
        round(math.log((t + prior * share) / (r + prior)) - math.log(share), 6)
        for r, t in zip(raw, target)
    ]


def _with_trusted(rows: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """``rows`` with the equal id of ``ids`` in ``__trusted``, else null.

    A filter of 8 MiB at most, of hashed ids is broadcast whatever their number. Rows that miss it have
    no equal and stay where they are; only texts of the others are shuffled to be compared.
    """
    trusted, given = F.col("__trusted"), quoted(id_column)
    if rows.schema[id_column].dataType != ids.schema["__trusted"].dataType:
        return rows.join(ids.hint("merge"), given == trusted, "left")  # hashes would differ

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS)) + 1

    spots = ids.select(place(trusted).alias("place"))
    filled = spots.groupBy(F.bitmap_bucket_number("place").alias("__part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("__bits")
    )
    place_of = place(given)
    bit = F.bitmap_bit_position(place_of)
    byte = F.substring(F.col("__bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    byte = F.conv(F.hex(byte), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, F.pmod(bit, F.lit(8)).cast("int"))
    hit = given.isNotNull() & (hit.bitwiseAND(F.lit(1)) == 1)
    looked_up = rows.join(
        F.broadcast(filled), F.bitmap_bucket_number(place_of) == F.col("__part"), "left"
    ).select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("__maybe"))
    maybe = looked_up.filter("__maybe").drop("__maybe")
    other = looked_up.filter("NOT __maybe").drop("__maybe")
    found = maybe.join(ids.hint("merge"), given == trusted, "left")
    return found.unionByName(other.withColumn("__trusted", F.lit(None)))


def _hashed(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _paired(hashes: Column, distance: int) -> Column:
    """Each element with the one ``distance`` places on; the last ones have none."""
    return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + distance)))


def _without_last(values: Column, n: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - n, F.lit(0)))


def _grams(one: Column, two: Column) -> Column:
    """Hashes of the words, then of the pairs."""
    return F.concat(one, _without_last(two, 1))


def _measures(text: Column, ratios: Column, buckets: int) -> Column:
    """The counts and the score of a text, as a struct."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))

    def score(grams):
        total = F.aggregate(
            grams,
            F.lit(0.0),
            lambda acc, x: acc + F.get(ratios, F.pmod(x, F.lit(buckets)).cast("int")),
        )
        return F.when(F.size(grams) > 0, total / F.size(grams)).otherwise(F.lit(0.0))

    def measures(w, one, two, eight):
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
            .cast("long")
            .alias("n_dup_lines"),
            let(_without_last(eight, WINDOW - 1), _repeated_words)
            .cast("long")
            .alias("n_repeat_words"),
            let(_grams(one, two), score).alias("score"),
        )

    return let(
        words(text),
        lambda w: let(
            _hashed(w),
            lambda one: let(
                _paired(one, 1),
                lambda two: let(
                    _paired(two, 2),
                    lambda four: let(
                        _paired(four, 4), lambda eight: measures(w, one, two, eight)
                    ),
                ),
            ),
        ),
    )


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more in the text.

    Only texts with such a window are sorted; most have none.
    """

    def repeated(places):
        def place(s, j):
            before, after = F.get(places, j - 1), F.get(places, j + 1)
            again = (before["key"] == s["key"]) | (after["key"] == s["key"])
            return F.when(again, s["at"])

        return F.array_sort(F.array_compact(F.transform(places, place)))

    def covered(at):
        def words_of(p, j):
            return F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)))

        return F.aggregate(F.transform(at, words_of), F.lit(0), lambda a, x: a + x)

    places = F.transform(windows, lambda x, i: F.struct(x.alias("key"), i.alias("at")))
    found = let(F.array_sort(places), lambda s: let(repeated(s), covered))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0))

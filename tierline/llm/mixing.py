"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time t in [0, 1], here linear
between ``early`` and ``late``. Its integral is the demand for that source's
words up to t; it is scaled so that the whole demand is the source's target.
Inverting the demand at the place where a document stands in its source's stream
gives the training time at which it is due, and rows are range-sorted by it.

A stream is the source's documents in the order of a hash of their ids, repeated
from the start until the target is met. The place of a document needs a running
sum. That is taken in two levels, over blocks of the hash order and inside each
block, so a source that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import quoted, require_columns, stored, word_count

#: The columns that a mix adds.
ADDED = (
    "mix_size",
    "mix_source_size",
    "mix_target",
    "mix_taken",
    "mix_copies",
    "mix_positions",
)


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix.

    ``weights`` are given to the sources in code-point order, null last, and
    repeat. Together the sources get ``share`` of all words; no target is above
    ``most`` times the words of its source, and what is cut there goes to the
    others by weight. ``early`` and ``late`` are the relative weights at the
    start and the end of training, for each entry of ``weights``.
    """

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    early: tuple[float, ...] = (1.5, 0.5, 1.0)
    late: tuple[float, ...] = (0.5, 1.5, 1.0)
    #: Rows of a block, about; a plan choice that changes no result.
    block_rows: int = 4_000

    def __post_init__(self):
        if not len(self.weights) == len(self.early) == len(self.late):
            raise ValueError("weights, early and late must have the same length")
        if min(self.weights) <= 0 or min(self.early + self.late) <= 0:
            raise ValueError("weights must be positive")
        if not 0 < self.share <= self.most:
            raise ValueError("share must be above 0 and no more than most")


def mix(
    docs: DataFrame,
    params: Mix = Mix(),
    id_column: str = "doc_id",
    source_column: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` with what the mix takes of them.

    ``size`` is what is counted, the words of the column ``text`` by default.
    Added columns, which replace any of the same name: ``mix_size``,
    ``mix_source_size``, ``mix_target`` (of the source), ``mix_taken`` (words taken, repeats counted), ``mix_copies``
    (``taken`` in whole documents, rounded), ``mix_positions`` (training time in
    [0, 1) of each copy that begins before the target is met).

    The stream ends where the demand does, inside a document if need be, so the
    words taken of a source are its target without the fraction.

    * Null and empty texts have size 0: nothing is taken, and no copies.
    * A null source is a source of its own, after all others.
    * A null id is ordered before the others; rows that repeat an id are
      ordered by size, and equal ones are interchangeable.
    * An empty table gives an empty result.
    """
    size = word_count(quoted("text")) if size is None else size
    require_columns(docs, id_column, source_column)
    ident = quoted(id_column)
    order = F.md5(F.coalesce(ident.cast("string"), F.lit("")))
    # The first 24 bits of the hash, as a share of the whole range.
    place = F.conv(F.substring("order", 1, 6), 16, 10).cast("long") / F.lit(float(2**24))
    columns = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(
        F.struct(*[quoted(c) for c in columns]).alias("doc"),
        ident.alias("id"),
        size.cast("long").alias("size"),
        order.alias("order"),
        quoted(source_column).alias("source"),
    ).withColumn("place", place)
    narrow = stored(rows.select("source", "size", "place"), "mix-sizes")
    sources = stored(_sources(narrow, params), "mix-targets")
    blocks = _blocks(narrow, sources)
    placed = _with_source(rows, sources).join(blocks, ["rank", "block"])
    running = (
        Window.partitionBy("rank", "block")
        .orderBy("order", "id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("size").over(running), F.lit(0))
    placed = placed.withColumn("start", (F.col("words_before") + inside).cast("long"))
    added = (
        F.col("size"),
        F.col("source_size"),
        F.col("target"),
        _taken(),
        F.when(F.col("size") == 0, F.lit(0))
        .otherwise(F.round(_taken() / F.col("size")))
        .cast("int"),
        _positions(params),
    )
    return placed.select(
        *[F.col("doc")[c].alias(c) for c in columns],
        *[c.alias(name) for name, c in zip(ADDED, added)],
    )


def training_order(mixed: DataFrame, columns: list[str], id_column: str = "doc_id") -> DataFrame:
    """A row per copy that the mix takes, range-sorted by training position."""
    copies = F.slice("mix_positions", F.lit(1), F.col("mix_copies"))
    return (
        mixed.select(*[quoted(c) for c in columns], F.explode(copies).alias("__position"))
        .orderBy("__position", quoted(id_column))
        .select(*[quoted(c) for c in columns])
    )


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with what is known of their source, and their block of its order."""
    named = sources.withColumnRenamed("source", "name")
    # A source is a group label, but nothing bounds how many there are: the
    # planner broadcasts this table only below the session's threshold.
    found = rows.join(named, rows["source"].eqNullSafe(named["name"])).drop("name")
    return found.withColumn("block", F.floor(F.col("place") * F.col("blocks")))


def _sources(narrow: DataFrame, params: Mix) -> DataFrame:
    """A row per source: rank, words, target, blocks and schedule.

    Targets fill up like water: there is a level with target = weight x level
    for all sources that stay below their limit. The sources are ordered by
    the level at which they reach it; the level is the first that fits, and
    what later ones would give is lower.
    """
    sizes = narrow.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(params.weights)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    kind = (F.col("rank") % n).cast("int")
    ranked = ranked.select(
        "source",
        "source_size",
        "rank",
        F.greatest(F.lit(1), F.ceil(F.col("rows") / params.block_rows)).alias("blocks"),
        _pick(params.weights, kind, "double").alias("weight"),
        _pick(params.early, kind, "double").alias("early"),
        _pick(params.late, kind, "double").alias("late"),
        (F.col("source_size") * F.lit(float(params.most))).alias("limit"),
    )
    fills = F.col("limit") / F.col("weight")
    full = Window.orderBy(fills, "rank")
    whole = Window.partitionBy()
    earlier = full.rowsBetween(Window.unboundedPreceding, -1)
    later = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    demand = F.sum("source_size").over(whole) * F.lit(float(params.share))
    levels = ranked.select(
        "*",
        fills.alias("fills"),
        (
            (demand - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0)))
            / F.sum("weight").over(later)
        ).alias("candidate"),
    )
    fits = F.when(F.col("candidate") <= F.col("fills"), F.col("candidate"))
    return levels.withColumn("level", F.max(fits).over(whole)).select(
        "source",
        "source_size",
        "rank",
        "blocks",
        "early",
        "late",
        F.when(F.col("level").isNull(), F.col("limit"))
        .otherwise(F.least("limit", F.col("weight") * F.col("level")))
        .alias("target"),
    )


def _pick(values, index: Column, kind: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index).cast(kind)


def _blocks(narrow: DataFrame, sources: DataFrame) -> DataFrame:
    """Words of a source before each of its blocks."""
    sums = (
        _with_source(narrow, sources)
        .groupBy("rank", "block")
        .agg(F.sum("size").alias("words"))
    )
    order = Window.partitionBy("rank").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        "rank",
        "block",
        F.coalesce(F.sum("words").over(order), F.lit(0)).alias("words_before"),
    )


def _taken() -> Column:
    """Whole passes over the source, and the part of the last one that is left."""
    target, total, size = F.floor("target"), F.col("source_size"), F.col("size")
    passes = F.call_function("div", target, F.greatest(total, F.lit(1)))
    rest = target - passes * total
    part = F.greatest(F.lit(0), F.least(size, rest - F.col("start")))
    return (passes * size + part).cast("long")


def _positions(params: Mix) -> Column:
    """Training time at which each copy is due: the demand, inverted.

    The demand up to t is target x (early t + (late - early) t^2 / 2) / mean.
    """
    passes = F.sequence(F.lit(0), F.lit(int(params.most)))
    early, late = F.col("early"), F.col("late")
    slope = late - early

    def due(k):
        words_before = F.col("start") + k * F.col("source_size")
        share = words_before / F.col("target") * (early + late) / 2
        root = F.sqrt(F.greatest(F.lit(0.0), early * early + 2 * slope * share))
        # The stable form of the quadratic's solution; right for slope 0 too.
        return 2 * share / (early + root)

    begins = lambda k: F.col("start") + k * F.col("source_size") < F.floor("target")
    return F.when(F.col("size") > 0, F.transform(F.filter(passes, begins), due)).otherwise(
        F.array().cast("array<double>")
    )

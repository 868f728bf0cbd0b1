"""Exact duplicates by skew-safe combining.

Three steps, each comparing whole texts and not digests alone:

1. every task combines the equal texts it reads (the map side of an aggregate);
2. what is left meets by digest **and salt**, so that a text which makes up a
   third of all rows is merged by as many tasks as there are salts;
3. the winners of the salts, at most one per salt and text, meet by digest.

The result goes back to all rows by (digest, salt), which splits a hot group over
the same salts again. Only digests travel for that. Should two different texts
ever share a digest, the rows of that digest are resolved by their whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import one_space, quoted, require_columns, stored

#: Salts of a digest; they are kept as the bits of a ``bigint``.
SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: its id, the id that stays, and the group's size.

    Texts are equal when identical after each run of ASCII white space is replaced
    by one space. Columns: the id, ``keep_id`` (smallest id of the group),
    ``group_size``, ``kept``, ``text_digest`` (binary).

    * A null text counts as empty; all empty texts are one group.
    * A null id comes after all others: such a row stays only if its whole group
      has null ids. Rows that repeat the id that stays are all marked as kept.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    if not 1 <= salts <= 63:
        raise ValueError(f"salts must be between 1 and 63, not {salts}")
    keyed = _keyed(docs, id_column, text_column, salts, digest)
    groups = stored(_groups(keyed), "exact-groups")
    shared = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    clashing = shared.select("digest")
    found = _spread(keyed.drop("content"), groups, salts)
    if not clashing.isEmpty():
        clashing = stored(clashing, "exact-clashes")
        found = found.join(clashing, "digest", "left_anti").unionByName(
            _by_content(keyed.join(clashing, "digest", "left_semi"))
        )
    return found.select(
        F.col("id").alias(id_column),
        F.col("first").alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("id").eqNullSafe(F.col("first")).alias("kept"),
        F.col("digest").alias("text_digest"),
    )


def drop_exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without the rows that :func:`exact_duplicates` does not keep.

    Rows that repeat both the id and the text of a row that stays are one
    document; one of them stays, the smallest by all its columns.
    """
    staying = (
        exact_duplicates(docs, id_column, text_column)
        .filter("kept")
        .select(quoted(id_column).alias("__id"), F.col("text_digest").alias("__kept"))
        .distinct()
    )
    rows = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("__doc"),
        quoted(id_column).alias("__own"),
        sha256(one_space(quoted(text_column))).alias("__digest"),
    )
    # The join deals the rows by id, so the window needs no further shuffle.
    same = F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__kept"))
    joined = rows.join(staying.hint("merge"), same, "left_semi")
    order = Window.partitionBy("__own", "__digest").orderBy(F.xxhash64("__doc"))
    first = joined.withColumn("__n", F.row_number().over(order)).filter("__n = 1")
    return first.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])


def _keyed(docs, id_column, text_column, salts, digest) -> DataFrame:
    ident, content = quoted(id_column), one_space(quoted(text_column))
    return docs.select(ident.alias("id"), content.alias("content")).select(
        "id",
        "content",
        digest(F.col("content")).alias("digest"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
    )


def _groups(keyed: DataFrame) -> DataFrame:
    """A row per text: digest, smallest id, number of rows, and salts as bits."""
    merged = keyed.groupBy("digest", "salt", "content").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    return (
        merged.groupBy("digest", "content")
        .agg(
            F.min("first").alias("first"),
            F.sum("copies").alias("copies"),
            F.bit_or(F.expr("shiftleft(1L, salt)")).alias("salts"),
        )
        .select("digest", "first", "copies", "salts")
    )


def _spread(rows: DataFrame, groups: DataFrame, salts: int) -> DataFrame:
    """Group results for each row, joined by digest and salt."""
    used = F.filter(
        F.sequence(F.lit(0), F.lit(salts - 1)),
        lambda s: F.call_function("getbit", F.col("salts"), s) == 1,
    )
    by_salt = groups.select("digest", F.explode(used).alias("salt"), "first", "copies")
    return rows.join(by_salt, ["digest", "salt"]).select("id", "digest", "first", "copies")


def _by_content(rows: DataFrame) -> DataFrame:
    groups = (
        rows.groupBy("digest", "salt", "content")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .groupBy("digest", "content")
        .agg(F.min("first").alias("first"), F.sum("copies").alias("copies"))
    )
    return rows.join(groups, ["digest", "content"]).select("id", "digest", "first", "copies")

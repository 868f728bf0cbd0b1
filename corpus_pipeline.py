"""A corpus pipeline: quality rules, exact and near deduplication, mixing, packing.

Each stage takes all rows that the one before kept, and its decisions take effect.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from tierline.llm.common import quoted, ship_package, stored, table
from tierline.llm.queries import tokenizer_path, trusted_ids


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    judged = quality_rules.quality(docs.select("doc_id", "text", row), trusted_ids(spark, sf_dir))
    return judged.filter("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id."""
    ship_package(spark)
    classes = near_dedup.near_duplicates(docs)
    staying = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    staying = staying.select(F.col("doc_id").alias("staying")).distinct()
    return docs.join(
        staying.hint("merge"), docs["doc_id"].eqNullSafe(staying["staying"]), "left_semi"
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it does, in training order."""
    return mixing.training_order(mixing.mix(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document stands in the training sequences."""
    ship_package(spark)
    return packing.pack(docs, packing.Packing(tokenizer_path()))


STAGES = [
    ("quality", keep_good),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Hashed n-grams and MinHash have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import (
    alignment,
    exact_dedup,
    factors,
    line_hashing,
    mixing,
    near_dedup,
    packing,
    phrases,
    quality_rules,
    repeats,
    search,
    toxicity,
    warc,
)
from tierline.llm.common import ship_package, stored, table, word_count

Query = Callable[[SparkSession, str], DataFrame]


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the documents that every label calls good."""
    labels = table(spark, sf_dir, "labels")
    return labels.groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality(docs, trusted_ids(spark, sf_dir)).drop("text")


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    mixed = mixing.mix(sized, size=F.col("size"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        F.col("mix_taken").alias("taken"),
        F.get("mix_positions", F.lit(0)).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return exact_dedup.exact_duplicates(docs).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("text_digest")).alias("text_sha256"),
    )


def tokenizer_path() -> str:
    """The public vocabulary file that sequences are packed with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, packing.Packing(tokenizer_path()))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_hashing.drop_repeated_units(docs, texts=False).drop("kept_text")


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_spans(table(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return repeats.drop_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "span_starts", "span_ends"
    )


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    written = warc.write_archives(pages, warc.archive_folder(spark))
    records = warc.read_archives(written, payloads=False)
    return records.select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return factors.quality_scores(docs, labels, metadata=("n_chars",))


def collocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_pack": pack,
    "op2_quality": quality,
    "op3_patience": aligned,
    "op4_toxicity": toxic,
    "op5_probminhash": near,
    "op6_suffix_radix": repeated_bytes,
    "op7_mix": mix,
    "op8_line_hashing": repeated_lines,
    "op9_exact_dedup": exact,
    "op10_warc": archive,
    "op11_reversed_search": ranked,
    "op12_factorisation_machine": good,
    "op13_son_phrases": collocated,
}

QUERIES: dict[str, Query] = {name: _shipped(query) for name, query in _QUERIES.items()}

import math
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from tests.llm.common import WORD, edge_rows, prose, table
from tierline.llm import quality_rules
from tierline.llm.quality_rules import QualityRules, log_ratios, quality

PARAMS = QualityRules(buckets=97, trusted_rows=50)


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def grams(text):
    one = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in WORD.findall(text or "")]
    pack = lambda v: struct.pack("<q", v)
    two = [
        signed(xxhash.xxh64_intdigest(pack(b), xxhash.xxh64_intdigest(pack(a), 42)))
        for a, b in zip(one, one[1:])
    ]
    return [g % PARAMS.buckets for g in one + two]


def brute_ratios(rows, trusted):
    raw, target = Counter(), Counter()
    for i, text in rows:
        raw.update(grams(text))
        if i in trusted:
            target.update(grams(text))
    share = sum(target.values()) / sum(raw.values())
    k = PARAMS.prior
    return [
        round(math.log((target[b] + k * share) / (raw[b] + k)) - math.log(share), 6)
        for b in range(PARAMS.buckets)
    ]


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {
        i + j
        for i in range(len(words) - 7)
        if windows[tuple(words[i : i + 8])] > 1
        for j in range(8)
    }
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def rows():
    found = edge_rows() + [(100 + i, prose(i, 30 + i)) for i in range(40)]
    found += [(200, "a b c d e f g h " * 5), (201, "x " * 40), (202, "p | q\np | q\n# * $\n\n r")]
    found += [(203, prose(3, 12) + " ! " + prose(4, 30) + " " + prose(3, 12))]
    return found + [(300 + i, " ".join(f"{w}&&&" for w in prose(i, 40).split())) for i in range(20)]


def test_counts_scores_and_verdicts_equal_brute_force(spark):
    data = rows()
    trusted = {i for i in range(100, 130)}
    ids = spark.createDataFrame([(i,) for i in trusted] + [(None,)], "doc_id long")
    ratios = brute_ratios(data, trusted)
    assert log_ratios(table(spark, data), ids, PARAMS) == ratios
    found = quality(table(spark, data), ids, PARAMS).collect()
    assert len(found) == len(data)
    for r in found:
        n, *rest = counts = brute_counts(r.text)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert tuple(r[name] for name in names) == counts, r.doc_id
        failed = n < 20 or 100 * rest[3] > 30 * n
        values = [ratios[b] for b in grams(r.text)]
        score = sum(values) / len(values) if values else 0.0
        assert math.isclose(r.score, score, abs_tol=1e-9)
        assert r.base_failed == failed
        assert r.kept == (not failed and r.score >= PARAMS.threshold)


def test_clashing_columns_empty_table_and_no_trusted(spark):
    docs, none = table(spark, rows()), spark.createDataFrame([], "doc_id long")
    found = quality(docs, none, PARAMS)
    assert sorted(found.columns) == sorted(
        [c for c in docs.columns if c != "kept"]
        + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        + ["base_failed", "score", "kept"]
    )
    assert {r.score for r in found.collect()} == {0.0}
    assert quality(table(spark, []), none, PARAMS).count() == 0


def test_all_trusted_documents_count(spark):
    """More than 20,000 of them; where every document is trusted no bucket stands out."""
    docs = spark.range(21_000).selectExpr("id as doc_id", "concat('w', id % 211) as text")
    assert set(log_ratios(docs, docs, QualityRules(buckets=97))) == {0.0}


def test_junk_is_told_from_prose(spark):
    data = rows()
    ids = spark.createDataFrame([(i,) for i in range(100, 120)], "doc_id long")
    found = {r.doc_id: r for r in quality(table(spark, data), ids, QualityRules(prior=5.0)).collect()}
    good = [found[i].score for i in range(120, 140)]
    bad = [found[i].score for i in range(300, 320)]
    assert max(bad) < min(good)


def test_trusted_ids_are_found_and_other_texts_stay(spark):
    given = [(i % 90 if i % 7 else None, f"text {i}") for i in range(200)]
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    wanted = sorted((t, i is not None and i % 3 == 0) for i, t in given)
    for kind in ("long", "int"):  # hashes of another type differ
        ids = spark.createDataFrame([(i,) for i in range(0, 300, 3)], f"__trusted {kind}")
        rows = quality_rules._with_trusted(docs, ids, "doc_id")
        found = rows.select("text", F.col("__trusted").isNotNull()).collect()
        assert sorted(map(tuple, found)) == wanted


def test_only_texts_that_pass_the_filter_are_shuffled(spark):
    docs = table(spark, [(i, f"text {i}") for i in range(50)]).select("doc_id", "text")
    ids = docs.select(F.col("doc_id").alias("__trusted")).limit(9)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (kept, "-1"):  # as with few ids, and with many
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            rows = quality_rules._with_trusted(docs, ids, "doc_id")
            plan = rows._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        # Two readings; both meet the filter, and one of them is sorted for the ids.
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
        assert plan.index("Union") < plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")

"""The factorisation machine: its sums, statistics and held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.common import edge_rows, prose, table
from tierline.llm import factors
from tierline.llm.queries import QUERIES

SMALL = factors.Factors(buckets=256, rank=3, bins=4, least_steps=150)


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, quality int, toxic int")


def poor(seed):
    return " | ".join(f"w{random.Random(seed + i).randrange(400)}" for i in range(60))


def corpus(n=120):
    return [(i, poor(i) if i % 3 == 0 else prose(i, 80)) for i in range(n)]


def is_held_out(ident):
    return zlib.crc32(("" if ident is None else str(ident)).encode()) % 5 == 0


def test_pairs_are_summed_in_linear_time():
    draw = np.random.default_rng(4)
    size, rank = 30, 4
    machine = factors.Machine(0.3, draw.normal(size=size), draw.normal(size=(size, rank)), None)
    row = np.sort(draw.integers(0, 6, 40))
    feature, value = draw.integers(0, size, 40), draw.normal(size=40)
    got = machine.logits(row, feature, value, 7)
    for r in range(7):
        x = [(feature[i], value[i]) for i in np.flatnonzero(row == r)]
        want = 0.3 + sum(machine.weight[f] * v for f, v in x)
        for a in range(len(x)):
            for b in range(a + 1, len(x)):
                want += machine.vectors[x[a][0]] @ machine.vectors[x[b][0]] * x[a][1] * x[b][1]
        assert got[r] == pytest.approx(want)


def plain_statistics(text):
    data = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = text.split("\n") if text else []
    count, size = max(len(words), 1), max(len(data), 1)
    times = Counter(words)
    letter = lambda b: chr(b).isascii() and chr(b).isalpha() or b >= 128
    punctuation = set(b".,;:!?'\"()-")
    empty = sum(not re.search(r"[^\x20\x09-\x0D]", x) for x in lines)
    return [
        len(data), len(words), len(lines), len(words) / max(len(lines), 1), len(data) / count,
        len(times) / count, max(times.values(), default=0) / count,
        sum(a == b for a, b in zip(words, words[1:])) / count,
        sum(65 <= b <= 90 for b in data) / size, sum(48 <= b <= 57 for b in data) / size,
        sum(b in punctuation for b in data) / size,
        sum(32 < b < 127 and not letter(b) and not 48 <= b <= 57 and b not in punctuation for b in data) / size,
        sum(b >= 0xC0 for b in data) / size,
        sum(not any(letter(b) for b in w) for w in words) / count, empty / max(len(lines), 1),
    ]


def test_statistics_equal_plain_ones():
    texts = [r[1] or "" for r in edge_rows()] + ["a\n\nb a\n", "\n", "x x x\n| | #1 É!", "A.B\n \n\tc c"]
    *_, got = factors.described(pa.array([t.encode() for t in texts]), 1 << 40)
    np.testing.assert_allclose(got, [plain_statistics(t) for t in texts])


def test_words_are_scaled_to_one():
    row, bucket, value, _ = factors.described(pa.array([b"a b a", b"", b"c"]), 1 << 20)
    np.testing.assert_allclose(np.bincount(row, value * value, 3), [1, 0, 1], rtol=1e-6)
    assert len(bucket) == 3


def test_poor_documents_are_told_apart(spark):
    rows = corpus()
    labels = labels_of(spark, [(i, int(i % 3 > 0)) for i, _ in rows])
    got = factors.quality_scores(table(spark, rows), labels, SMALL).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    for r in got:
        assert r.held_out == is_held_out(r.doc_id)
        assert r.predicted == int(r.doc_id % 3 > 0) == int(r.score >= 0.3)


def scores(spark, rows, labels, params=SMALL, **options):
    result = factors.quality_scores(table(spark, rows), labels_of(spark, labels), params, **options)
    assert result.columns == ["doc_id", "held_out", "score", "predicted"]
    return result.collect()


def test_held_out_labels_and_other_columns_are_never_read(spark):
    rows = corpus(60)
    labels = [(i, int(i % 3 > 0)) for i, _ in rows]
    turned = [(i, 1 - q if is_held_out(i) else q) for i, q in labels]
    assert Counter(scores(spark, rows, labels)) == Counter(scores(spark, rows, turned))
    elsewhere = [(i, t, f"other{i}") for i, t in rows]
    assert Counter(scores(spark, rows, labels)) == Counter(scores(spark, elsewhere, turned))


def test_edge_rows_conflicts_and_null_labels(spark):
    rows = edge_rows() + corpus(40)
    labels = [(i, int(i % 3 > 0)) for i in range(40)] + [(1, 0), (4, None), (None, 1), (9_999, 0)]
    got = scores(spark, rows, labels)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(0 <= r.score <= 1 for r in got)
    by_text = {}
    for r in scores(spark, [(1, None), (1, ""), (2, ""), (3, "one"), (4, "one")], labels):
        by_text.setdefault(r.doc_id in (3, 4), set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_nothing_to_learn_from(spark):
    rows = [(i, prose(i, 20)) for i in range(20)]
    assert {r.score for r in scores(spark, rows, [])} == {0.5}
    own = [i for i in range(20) if not is_held_out(i)]
    assert {r.score for r in scores(spark, rows, [(i, 1) for i in range(20)])} == {
        (len(own) + 1) / (len(own) + 2)
    }
    assert scores(spark, [], [(1, 1)]) == []
    assert len(scores(spark, rows, [(i, i % 2) for i in range(20)])) == 20


def test_metadata_may_be_missing(spark):
    rows = corpus(40)
    docs = table(spark, rows).selectExpr("*", "if(doc_id % 2 = 0, null, doc_id) AS tally")
    labels = labels_of(spark, [(i, int(i % 3 > 0)) for i in range(40)])
    got = factors.quality_scores(docs, labels, SMALL, metadata=("tally", "n_chars")).collect()
    assert len(got) == 40
    with pytest.raises(ValueError):
        factors.quality_scores(docs, labels, SMALL, metadata=("absent",))


def test_sample_is_bounded(spark):
    rows = corpus(80)
    labels = labels_of(spark, [(i, int(i % 3 > 0)) for i, _ in rows])
    docs = table(spark, rows)
    few = factors.Factors(buckets=256, rank=2, bins=4, sample_rows=30, sample_features=900, least_steps=20)
    assert factors.quality_scores(docs, labels, few).count() == 80


@pytest.mark.parametrize("sf, recall, wrong", [("sf0.1", 0.95, 0.005), ("sf0.01", 0.8, 0.02)])
def test_held_out_accuracy_on_the_given_tables(spark, sf, recall, wrong):
    folder = f"/root/testdata/{sf}"
    got = QUERIES["op12_factorisation_machine"](spark, folder)
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    low = [r.predicted for r in rows if r.quality == 0]
    good = [r.predicted for r in rows if r.quality == 1]
    assert low.count(0) / len(low) >= recall
    assert good.count(0) / len(good) <= wrong

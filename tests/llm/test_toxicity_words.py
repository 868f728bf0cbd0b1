"""No word or pair of the labelled documents is cut for being rarer than others."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.common import table
from tierline.llm.arrays import mixed
from tierline.llm.toxicity import (
    Model,
    _distinct_pairs,
    _means,
    _moving,
    _ranks,
    _size,
    _words,
    estimated,
    toxicity,
)


def test_a_toxic_word_behind_thousands_of_common_ones_counts(spark):
    draw, common = random.Random(1), [f"c{k}" for k in range(5_100)]
    rows, labels = [], []
    for i in range(200):
        words = draw.sample(common, len(common))
        if i % 4 == 0:  # half of the toxic ones
            for k in (9, 99, 999, 1_999, 2_999):
                words.insert(k, "zorg")
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 2 == 0)))
    rows += [(900, "zorg here"), (901, "here there")]
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {r.doc_id: r.score for r in toxicity(table(spark, rows), known).collect()}
    assert found[900] > found[901] + 0.1


def test_pairs_of_all_documents_are_told_apart_by_their_words():
    texts = ["a b a b c", "x b", "b", "", "y b a"]
    batch = pa.record_batch([pa.array([t.encode() for t in texts], pa.binary())], ["text"])
    found, registers = _distinct_pairs(iter([batch]), np.empty(0, np.uint64), np.zeros(1, np.int64))
    pairs = {p for t in texts for p in zip(["", *t.split()], t.split())}
    assert found.num_rows == len(pairs) and set(found.column(0).to_pylist()) == {0}
    assert registers.num_rows == len(pairs) and max(registers.column(0).to_pylist()) < 0
    none, again = _distinct_pairs(iter([batch]), np.empty(0, np.uint64), np.empty(0, np.int64))
    assert none.num_rows == 0 and again == registers


@pytest.mark.parametrize("n", [0, 1, 100, 5_000, 200_000, 3_000_000])
def test_registers_count_distinct_hashes(n):
    hashes = mixed(np.arange(n, dtype=np.uint64))
    registers = _ranks(np.concatenate((hashes, hashes[: n // 2])))
    halves = np.maximum(_ranks(hashes[::2]), _ranks(hashes[1::2]))
    assert (registers == halves).all()
    assert abs(estimated(registers) - n) <= 0.03 * n


def test_leaving_out_words_without_weight_keeps_scores():
    draw, texts = random.Random(3), []
    for _ in range(50):
        texts.append(" ".join(draw.choice("abcdefgh") for _ in range(draw.randrange(9))).encode())
    hashes = np.unique(_words(pa.array([b"a b c d e f"], pa.binary())).hash)
    size = _size(hashes)
    word = np.zeros(size)
    word[2] = 1.5
    pairs = np.array([1 * size + 3, 3 * size + 2, (size - 1) * size + 4])
    model = Model(hashes, word, pairs, np.array([0.5, -2.0, 4.0]))
    less = _moving(model)
    assert len(less.vocabulary) < len(hashes)
    batch = pa.record_batch([pa.array(range(50)), pa.array(texts, pa.binary())], ["id", "text"])
    means = [next(_means(iter([batch]), m)).column(1).to_numpy() for m in (model, less)]
    assert np.allclose(*means) and means[0].any()

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.common import edge_rows, prose, table
from tierline.llm import arrays, repeats
from tierline.llm.repeats import Repeats, drop_repeats, runs_of


def brute(rows, length):
    count = Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[p : p + length] for p in range(len(data) - length + 1))
    result = []
    for i, text in rows:
        data = (text or "").encode()
        mask = bytearray(len(data) + 1)
        done = 0
        for p in range(len(data) - length + 1):
            if count[data[p : p + length]] > 1:
                low = max(p, done)
                mask[low : p + length] = b"\1" * (p + length - low)
                done = p + length
        kept = bytes(c for c, m in zip(data, mask) if not m)
        spans = sum(mask[k] and not mask[k - 1] for k in range(1, len(mask))) + mask[0]
        result.append(
            (i, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
        )
    return sorted(result, key=str)


def got(df):
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def rows():
    passage = prose(40, 30, 5_000)
    found = [(100 + i, f"{prose(i, 10 + i)} {passage[i:]} {prose(i + 9, 5)}") for i in range(30)]
    found += [(200, "ab" * 400), (201, "x" * 500), (202, "é" * 300), (203, passage * 3)]
    return found + [r for r in edge_rows() if r[0] not in (8, 9)] + [(8, prose(1, 2_000, 3_000))]


@pytest.mark.parametrize("length, gram", [(60, 30), (25, 3), (120, 119), (2, 1)])
def test_removed_bytes_equal_brute_force(spark, length, gram):
    data = rows()
    found = drop_repeats(table(spark, data).repartition(5), Repeats(length, gram), texts=True)
    assert got(found) == brute(data, length)
    texts = defaultdict(set)
    for i, text in data:
        texts[i].add((text or "").encode())
    for r in found.collect():
        assert hashlib.sha256(bytes(r.kept_text)).hexdigest() == r.kept_sha256
        if len(texts[r.doc_id]) == 1:
            (text,) = texts[r.doc_id]
            kept, at = b"", 0
            for a, b in zip(r.span_starts, r.span_ends):
                kept, at = kept + text[at:a], b
            assert kept + text[at:] == bytes(r.kept_text)


def test_default_length_over_a_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    data = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(drop_repeats(docs)) == brute(data, 400)


def test_empty_table_and_bad_parameters(spark):
    assert drop_repeats(table(spark, [])).count() == 0
    for bad in ((400, 400), (400, 0), (1 << 21, 5)):
        with pytest.raises(ValueError):
            Repeats(*bad)


def test_runs_hold_each_window_once_whatever_the_slices(monkeypatch):
    texts = [(t or "").encode() for _, t in rows()]
    column = arrays.texts_of(pa.array(texts, pa.binary()))
    params = Repeats(40, 15)

    def windows():
        r = runs_of(*column, params)
        each = [
            (row, s + k, a)
            for row, s, n, a in zip(r["row"], r["start"], r["count"], r["anchor"])
            for k in range(n)
        ]
        return sorted(each)

    whole = windows()
    assert [w[:2] for w in whole] == [
        (i, p) for i, t in enumerate(texts) for p in range(len(t) - 39)
    ]
    monkeypatch.setattr(repeats, "_SLICE", 101)
    assert windows() == whole


def test_equal_strings_have_equal_hashes():
    data = np.frombuffer(b"abcabcabc" * 50, dtype=np.uint8)
    hashes = repeats.Hashes(data)
    every = hashes.all(30)
    assert len(set(every.tolist())) == 3 and (every[:3] == every[3:6]).all()
    assert (hashes.of(np.array([0, 3, 7]), 30) == every[[0, 3, 7]]).all()


@pytest.mark.parametrize("size", [0, 1, 150, 199, 200, 201, 399, 400, 401])
def test_short_texts_alone_in_a_task(spark, size):
    text = prose(3, 400)[:size]
    for data in ([(1, text)], [(1, text), (2, text)]):
        assert got(drop_repeats(table(spark, data).coalesce(1))) == brute(data, 400)


def test_every_text_in_a_task_of_its_own(spark):
    passage = prose(5, 200)
    data = [(i, passage[: 90 * i]) for i in range(12)]
    assert got(drop_repeats(table(spark, data).repartition(40))) == brute(data, 400)


def test_a_portion_without_any_window(spark):
    data = [(i, f"{i:040d}") for i in range(10_001)]
    found = drop_repeats(table(spark, data).coalesce(1))
    assert found.count() == 10_001 and found.filter("n_removed > 0").isEmpty()


@pytest.mark.parametrize("rest", [0, 1, 14, 15, 38, 39, 40, 41])
def test_last_slice_may_be_shorter_than_a_gram(monkeypatch, rest):
    monkeypatch.setattr(repeats, "_SLICE", 256)
    data = prose(8, 200).encode()[: 512 + rest]
    r = runs_of(*arrays.texts_of(pa.array([data])), Repeats(40, 15))
    assert sum(r["count"]) == len(data) - 39


@pytest.mark.parametrize("rest", [1, 50, 198, 199, 399, 400])
def test_last_slice_of_a_megabyte(rest):
    data = np.random.default_rng(rest).integers(97, 123, (1 << 20) + rest, dtype=np.uint8).tobytes()
    r = runs_of(*arrays.texts_of(pa.array([data])), Repeats())
    assert sum(r["count"]) == len(data) - 399


def test_different_texts_under_one_id_lose_their_own_spans(spark):
    passage = prose(6, 150)[:600]
    data = [(1, f"first {passage} one"), (1, prose(7, 50)[:250]), (2, f"other {passage}"), (1, ""),
            (None, f"no id {passage}"), (None, prose(9, 60)), (1, f"{passage} last")]
    found = drop_repeats(table(spark, data).repartition(3))
    assert got(found) == brute(data, 400)

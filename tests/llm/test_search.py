"""Search turned round against a plain ranking of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import edge_rows, prose, table
from tierline.llm import arrays, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, most=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = Counter()
    for item, wanted in asked.items():
        scored = []
        for i, c in held:
            n = sum(c.values())
            m = 100 - 90 + 90 * n * n_docs // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in wanted
                if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:most], 1):
            out[(item, rank, i, -score)] += 1
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "item_id long, text string, rank int")


def found(spark, docs, items, params=search.Search()):
    result = search.search(table(spark, docs), items_of(spark, items), params)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return Counter(tuple(r) for r in result.collect())


def test_edge_rows(spark):
    items = [(1, "one W1 w2, w3"), (2, None), (3, ""), (4, "nothing-like/that"), (None, "ÜNÏ üNï w7"),
             (5, "w1"), (5, "w9 w1"), (6, prose(2, 60)), (7, "no id HERE"), (8, "çödé x one")]
    assert found(spark, edge_rows(), items) == brute([r[:2] for r in edge_rows()], items)


def test_ties_go_by_id_and_repeated_rows_count_each(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(7, "same words here"), (None, "same words here")]
    docs += [(100 + i, prose(i, 30)) for i in range(60)]
    items = [(1, "same"), (2, "w1 w2 w3 here"), (3, "words " * 50)]
    got = found(spark, docs, items)
    assert got == brute(docs, items)
    assert [k[2] for k in sorted(got.elements(), key=lambda k: k[:2]) if k[0] == 1][:8] == [1, 2, 3, 4, 5, 6, 7, 7]


def test_blocks_of_items_give_the_same(spark):
    docs = [(i, prose(i, 5 + i % 90, 120)) for i in range(300)]
    items = [(i, prose(1000 + i, 1 + i % 25, 150)) for i in range(60)]
    want = brute(docs, items, 4)
    assert found(spark, docs, items, search.Search(most=4)) == want
    assert found(spark, docs, items, search.Search(most=4, block_entries=60)) == want


def test_one_document_holds_most_and_one_term_is_everywhere(spark):
    docs = [(0, "common " * 30_000 + prose(1, 500))] + [(i, f"common {prose(i, 9)}") for i in range(1, 200)]
    items = [(i, f"common w{i}") for i in range(30)]
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    for docs, items in (([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, " . ")], [(1, "a")])):
        assert not found(spark, docs, items)


def test_text_ids_of_items(spark):
    items = spark.createDataFrame([("b", "w1 w2"), ("a", "w3")], "name string, body string")
    docs = table(spark, [(1, "w1 w3"), (2, "w3 w9")])
    result = search.search(docs, items, item_column="name", item_text_column="body")
    assert {(r.name, r["rank"], r.doc_id) for r in result.collect()} == {("a", 1, 1), ("a", 2, 2), ("b", 1, 1)}
    with pytest.raises(ValueError):
        search.search(docs, items.withColumnRenamed("name", "doc_id"), item_column="doc_id", item_text_column="body")
    with pytest.raises(ValueError):
        search.search(docs, items)


def index_of(words):
    rows = pa.table({"item": pa.array(range(len(words))), "term": pa.array(sorted(words))})
    return search._index(rows)


def places(index, text):
    data, offsets = arrays.texts_of(pa.array([text.encode()]))
    w = arrays.words(data, offsets, fold=arrays.LOWER, separator=search.SEPARATOR)
    return search._place(data, w, index)


def test_equal_hashes_are_told_apart_by_their_bytes():
    index = index_of(["alpha", "beta", "gamma"])
    letters = index.letters.tobytes()
    names = [letters[a:b].decode() for a, b in zip(index.at, index.at[1:])]
    assert [names[p] for p in places(index, "beta ALPHA gamma")] == ["beta", "alpha", "gamma"]
    data, offsets = arrays.texts_of(pa.array([b"delta"]))
    w = arrays.words(data, offsets, fold=arrays.LOWER, separator=search.SEPARATOR)
    fake = search.Index(
        np.sort(np.concatenate((w.hash, [np.uint64(1), np.uint64(2)]))), index.letters, index.at,
        index.first, index.item, index.ids,
    )
    assert places(fake, "delta").tolist() == [-1]
    both = search.Index(
        np.array([5, 5, 5], dtype=np.uint64), index.letters, index.at, index.first, index.item, index.ids
    )
    assert [names[p] if p >= 0 else None for p in places(both, "gamma x beta")] == ["gamma", None, "beta"]


def test_length_weight_beyond_64_bits():
    n = np.array([1, 3, 10**9], dtype=np.int64)
    sizes = (10**12, 4 * 10**14)
    want = [10 + 90 * x * sizes[0] // sizes[1] for x in n.tolist()]
    assert search.length_weight(n, sizes, 90).tolist() == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=3, max_size=3), max_size=30), st.integers(1, 9))
def test_heaps_keep_the_best(rows, cut):
    heaps = search.Heaps(3, 2)
    draw = random.Random(cut)
    doc = np.array([draw.randrange(50) for _ in rows], dtype=np.int64)
    null = np.array([draw.random() < 0.2 for _ in rows], dtype=bool)
    for low in range(0, len(rows), cut):
        part = slice(low, low + cut)
        heaps.add(np.array(rows[part], dtype=np.int64).reshape(-1, 3), doc[part], null[part])
    got = sorted(zip(heaps.item.tolist(), (-heaps.score).tolist(), heaps.null.tolist(), heaps.doc.tolist()))
    want = []
    for item in range(3):
        every = sorted((-r[item], bool(z), int(d)) for r, z, d in zip(rows, null, doc) if r[item])
        want += [(item, *e) for e in every[:2]]
    assert got == want

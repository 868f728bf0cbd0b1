import itertools
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.common import WORD, edge_rows, prose, table
from tierline.llm import arrays, near_dedup
from tierline.llm.components import components
from tierline.llm.near_dedup import (
    Joined,
    NearDuplicates,
    near_duplicates,
    probability_jaccard,
    shingles_of,
    signatures,
    similar_pairs,
)


def shingles(text, n=5):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else Counter()


def naive(x, y):
    return sum(
        1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in x.keys() | y.keys())
        for i in x.keys() & y.keys()
    )


def edited(text, changes, seed):
    words, draw = text.split(" "), random.Random(seed)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return " ".join(words)


def brute(rows, threshold=0.8):
    """Classes from all pairs of documents; a null id is a document for each text."""
    last = 2**62
    keys = [(last + hash(t) % last) if i is None else i for i, t in rows]
    texts = {}
    for i, (_, text) in zip(keys, rows):
        texts.setdefault(i, []).append(text)
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(
        [(i, shingles(t)) for i, own in texts.items() for t in own], 2
    ):
        if (not a and not b) or (a and b and naive(a, b) >= threshold - 1e-12):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    return sorted(
        ((i, root(k) if root(k) < last else None) for k, (i, _) in zip(keys, rows)), key=str
    )


def rows():
    base = prose(77, 150, 5_000)
    found = [(100 + i, edited(base, i % 6, i)) for i in range(40)]
    found += [(200 + i, edited(prose(i, 80, 5_000), 2, i)) for i in range(10)]
    found += [(300 + i, edited(prose(i, 80, 5_000), 1, 50 + i)) for i in range(10)]
    found += [(400, "a b c d"), (401, "a  b c\nd"), (402, "a b c e"), (403, "b " * 40), (404, "b " * 41)]
    short = [r for r in edge_rows() if r[0] not in (8, 9)]
    found += [(10, edited(base, 1, 1)), (None, "no id here"), (None, edited(prose(305, 80, 5_000), 1, 9))]
    return found + short + [(8, prose(1, 900, 3_000)), (9, prose(1, 900, 3_000) + " end")]


def got(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=str)


def test_classes_equal_brute_force(spark):
    data = rows()
    assert got(near_duplicates(table(spark, data))) == brute(data)


def test_blocks_of_a_bucket_with_several_components(spark):
    """Short bands put different texts into one bucket; blocks of 3 texts compare them."""
    base = prose(5, 60, 5_000)
    data = [(i, edited(base, i % 9, i)) for i in range(60)]
    params = NearDuplicates(bands=40, rows=2, block_texts=3)
    assert got(near_duplicates(table(spark, data), params)) == brute(data)


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).count() == 0
    assert got(near_duplicates(table(spark, [(1, "x"), (2, None)]))) == [(1, 1), (2, 2)]


def arrow(texts):
    return arrays.texts_of(pa.array([t.encode() for t in texts], pa.binary()))


def test_signatures_estimate_the_probability_jaccard():
    texts = [prose(9, 200, 60) + " " + prose(k, 30 * k, 60) for k in range(1, 8)] + ["", "x", "x y"]
    s, _ = shingles_of(*arrow(texts), 2)
    size = 4_000
    found = signatures(s, len(texts), size)
    for i, j in itertools.combinations(range(7), 2):
        expected = naive(shingles(texts[i], 2), shingles(texts[j], 2))
        assert abs(np.mean(found[i] == found[j]) - expected) < 5 * math.sqrt(0.25 / size)
    assert not found[7].any() and len(set(found[8].tolist())) == 1


@pytest.mark.parametrize("vocabulary", [8, 3_000])
def test_exact_similarity_of_pairs_and_blocks(vocabulary):
    base = prose(1, 60, vocabulary)
    texts = [edited(base, k // 2, k) for k in range(24)] + [base + " " + base, "", "q"]
    s, _ = shingles_of(*arrow(texts), 5)
    want = {}
    for i in range(len(texts)):
        for j in range(len(texts)):
            x, y = slice(s.first[i], s.first[i + 1]), slice(s.first[j], s.first[j + 1])
            exact = naive(shingles(texts[i]), shingles(texts[j]))
            found = probability_jaccard(s.hash[x], s.weight[x], s.hash[y], s.weight[y])
            assert math.isclose(found, exact, abs_tol=1e-9)
            want[i, j] = exact
    for n in (1, 9, 26):
        wanted = np.ones((n, len(texts) - n), dtype=bool)
        wanted[0, 0] = False
        found = similar_pairs(s, n, wanted, 0.8)
        for i in range(n):
            for j in range(len(texts) - n):
                expected = want[i, n + j] >= 0.8 - 1e-12 and (i, j) != (0, 0)
                assert found[i, j] == expected


def test_a_block_takes_memory_for_its_own_shingles():
    base = prose(1, 60, 3_000)
    s, _ = shingles_of(*arrow([edited(base, k % 4, k) for k in range(32)]), 5)
    tracemalloc.start()
    similar_pairs(s, 16, np.ones((16, 16), dtype=bool), 0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 22


def test_a_component_is_joined_once_in_a_task(monkeypatch):
    """Texts with repeated shingles that all reach each other: one link a component."""
    base = prose(3, 200, 3_000) + " a b c d e f" * 2
    block = [
        {"doc": i, "label": i, "text": edited(base, 1, i).encode()} for i in range(20)
    ]
    kind = pa.list_(pa.struct([("doc", pa.int64()), ("label", pa.int64()), ("text", pa.binary())]))
    both = [pa.array([block[1:]] * 3, kind), pa.array([block] * 3, kind)]
    worked_out = []
    exact = near_dedup.probability_jaccard
    monkeypatch.setattr(
        near_dedup, "probability_jaccard", lambda *x: worked_out.append(1) or exact(*x)
    )
    batch = pa.RecordBatch.from_arrays(both, ["few", "all"])
    found = near_dedup._similar_blocks(iter([batch]), NearDuplicates())
    assert sum(b.num_rows for b in found) == 19 == len(worked_out)


def test_joined_components():
    joined = Joined()
    assert joined.join(5, 9) and joined.join(9, 2) and not joined.join(5, 2)
    assert joined.roots(np.array([9, 5, 7, 2])).tolist() == [2, 2, 7, 2]


def test_components_equal_union_find(spark):
    draw = random.Random(8)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)]
    links += [(k, k + 1) for k in range(400, 460)] + [(1_000, k) for k in range(1_001, 1_100)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {i: root(i) for i in parent}
    assert len(found) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

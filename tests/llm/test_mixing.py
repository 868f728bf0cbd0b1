import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.common import WORD, edge_rows, prose, table
from tierline.llm.mixing import Mix, mix, training_order


def rows():
    found = [(i, prose(i, 1 + i % 37), f"s{min(i % 9, 4)}") for i in range(300)]
    found += [(1000 + i, prose(i, 50), None) for i in range(3)]
    return found + [(r[0], r[1], "Z") for r in edge_rows()]


def brute_targets(sizes, params):
    """Fill up by weight, again and again, and cap."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: params.weights[k % len(params.weights)] for k, s in enumerate(order)}
    target, left = {}, params.share * sum(sizes.values())
    rest = set(order)
    while rest:
        total = sum(weight[s] for s in rest)
        full = {s for s in rest if left * weight[s] / total > params.most * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in rest}
            break
        for s in full:
            target[s] = params.most * sizes[s]
            left -= target[s]
        rest -= full
    return target


@pytest.mark.parametrize("block_rows", [5, 4_000])
def test_targets_and_words_taken(spark, block_rows):
    data, params = rows(), Mix(block_rows=block_rows)
    found = mix(table(spark, data), params).collect()
    assert len(found) == len(data)
    sizes, taken, documents = defaultdict(int), defaultdict(int), defaultdict(list)
    for i, text, source in data:
        sizes[source] += len(WORD.findall(text or ""))
    target = brute_targets(sizes, params)
    for r in found:
        assert r.mix_size == len(WORD.findall(r.text or ""))
        assert r.mix_source_size == sizes[r.source]
        assert math.isclose(r.mix_target, target[r.source], rel_tol=1e-9)
        assert 0 <= r.mix_taken <= 2 * r.mix_size
        assert all(0 <= p < 1 for p in r.mix_positions)
        assert list(r.mix_positions) == sorted(r.mix_positions)
        assert len(r.mix_positions) >= r.mix_copies
        taken[r.source] += r.mix_taken
        key = hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()
        documents[r.source].append((key, r.mix_size, r.mix_taken))
    for source in sizes:
        assert taken[source] == math.floor(target[source])
        # The last pass over the source stops at the target, in the order of the hash.
        rest = math.floor(target[source]) % max(sizes[source], 1)
        done = math.floor(target[source]) // max(sizes[source], 1)
        for _, size, got in sorted(documents[source]):
            assert got == done * size + max(0, min(size, rest))
            rest -= size


def test_positions_invert_the_demand(spark):
    params = Mix(weights=(1,), early=(1.5,), late=(0.5,), share=1.0)
    data = [(i, prose(i, 10)) for i in range(200)]
    found = mix(table(spark, data), params).select(F.explode("mix_positions")).collect()
    at = sorted(r[0] for r in found)
    for k, t in enumerate(at):
        # Document k begins after 10 k of 2,000 words; the demand up to t is 1.5 t - t^2 / 2.
        assert math.isclose(1.5 * t - 0.5 * t * t, k / 200, abs_tol=1e-9)


def test_training_order_repeats_rows_and_keeps_columns(spark):
    docs = table(spark, rows())
    mixed = mix(docs)
    ordered = training_order(mixed, docs.columns)
    assert ordered.columns == docs.columns
    assert ordered.count() == mixed.agg(F.sum("mix_copies")).first()[0]


def test_own_columns_replace_those_of_the_same_name(spark):
    docs = table(spark, rows()).withColumn("mix_size", F.lit("x"))
    assert mix(docs).columns.count("mix_size") == 1
    assert dict(mix(docs).dtypes)["mix_size"] == "bigint"


def test_empty_table_and_bad_parameters(spark):
    assert mix(table(spark, [])).count() == 0
    assert mix(table(spark, [(1, None), (2, "")])).filter("mix_taken > 0").count() == 0
    for bad in ({"weights": (1, 0, 1)}, {"share": 3.0}, {"early": (1.0,)}):
        with pytest.raises(ValueError):
            Mix(**bad)

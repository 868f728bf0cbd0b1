"""Pairs of documents are found wherever they share a block, against all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.common import prose, table
from tests.llm.test_alignment import lines, rows
from tierline.llm.alignment import WHOLE, Alignment, aligned_spans, blocks, patience, runs_of


def over_all_pairs(data, params):
    """Lines removed from each document when all pairs are aligned."""
    parsed = {i: [w for _, w in lines(t)] for i, t in data}
    gone = defaultdict(set)
    for b, y in parsed.items():
        for a, x in parsed.items():
            if a < b:
                gone[b] |= set(blocks(patience(x, y), [len(w) for w in y], params.block_words))
    return {i: len(gone[i]) for i in parsed}


def frequent_lines():
    """Lines that are each first met alone; some documents share two in a row."""
    line = [prose(9_000 + k, 6, 5_000) for k in range(4)]
    found = [(k, f"{line[k]}\n{prose(k, 8, 5_000)}") for k in range(4)]
    found += [(10 + k, f"{prose(50 + k, 8, 5_000)}\n{line[k % 4]}") for k in range(40)]
    found += [(60 + k, f"{prose(90 + k, 8, 5_000)}\n{line[0]}\n{line[1]}") for k in range(3)]
    # Lines of under five words make a block together.
    short = "\n".join(f"s{k} t{k} u{k}" for k in range(4))
    return found + [(70, f"{short}\nend a"), (71, f"b\n{short}")]


def reordered():
    """Blocks that the first holder has in another order than the others."""
    part = [prose(300 + k, 12, 5_000) for k in range(3)]
    draw = random.Random(5)
    found = []
    for i in range(30):
        draw.shuffle(part)
        own = [prose(1_000 + 10 * i + k, 9, 5_000) for k in range(4)]
        found.append((i, "\n".join(x for k in range(3) for x in (own[k], part[k]))))
    return found


@pytest.mark.parametrize("make", [frequent_lines, reordered, rows])
@pytest.mark.parametrize("params", [WHOLE, Alignment(block_words=3, every_block=True)])
def test_removed_lines_equal_those_over_all_pairs(spark, make, params):
    data = make()
    found = {r.doc_id: r.n_removed_lines for r in aligned_spans(table(spark, data), params).collect()}
    assert found == over_all_pairs(data, params)
    if make is frequent_lines:
        assert found[61] == 2 and found[71] == 4
    if params == WHOLE:
        default = aligned_spans(table(spark, data)).collect()
        assert {r.doc_id: r.n_removed_lines for r in default} == found


def test_every_line_of_a_run_of_enough_words_is_in_a_hashed_run_within_it():
    draw = np.random.default_rng(1)
    for _ in range(50):
        n, least = int(draw.integers(1, 12)), int(draw.integers(1, 12))
        words = draw.integers(1, 8, n)
        low, high, _ = runs_of(draw.integers(0, 2**62, n), words, least)
        for a in range(n):
            for b in range(a + 1, n + 1):
                if words[a:b].sum() >= least:
                    within = [(x, y) for x, y in zip(low, high) if a <= x and y <= b]
                    assert {k for x, y in within for k in range(x, y)} == set(range(a, b))


def test_hashes_of_runs_do_not_depend_on_where_they_are():
    passage = np.arange(100, 105)
    runs = [
        set(runs_of(np.concatenate((np.arange(k), passage)), np.full(k + 5, 4), 10)[2].tolist())
        for k in (0, 1, 7)
    ]
    assert len(runs[0]) == 3 and runs[0] <= runs[1] and runs[0] <= runs[2]

"""The whole toxicity score against the same models in plain Python."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import edge_rows, prose, table
from tierline.llm import toxicity as module
from tierline.llm.toxicity import Toxicity, _curve, toxicity
from tierline.llm.toxicity import estimated as real

START = object()


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def pairs_of(text):
    found = words(text)
    return list(zip([START, *found], found))


class Plain:
    """Log ratios of words and pairs, from (text, toxic) and all texts."""

    def __init__(self, learned, texts, vocabulary, params):
        d, size = params.discount, len(vocabulary) + 2
        n = [Counter(), Counter()]
        for text, toxic in learned:
            n[toxic].update(set(pairs_of(text)))
        self.total = [sum(c.values()) for c in n]
        first, fan, second, follows = ([Counter(), Counter()] for _ in range(4))
        for k in (0, 1):
            for (h, w), c in n[k].items():
                first[k][h] += c
                fan[k][h] += 1
                second[k][w] += c
                follows[k][w] += 1
        before = defaultdict(set)
        for text in texts:
            for h, w in pairs_of(text):
                before[w].add(h)
        every = sum(map(len, before.values()))
        base = {w: (len(before[w]) + 0.5) / (every + 0.5 * size) for w in vocabulary}
        added = [2 * t / sum(self.total) for t in self.total]

        def far(counts):
            rates = [(c + a) / t for c, a, t in zip(counts, added, self.total)]
            return abs(math.log(rates[1] / rates[0])) > math.log(params.factor)

        def word(k, w):
            if w not in base or not far([second[0][w], second[1][w]]):
                return base.get(w, 1.0)
            lower = max(follows[k][w] - d, 0) + d * len(follows[k]) * base[w]
            return lower / sum(follows[k].values())

        def pair(k, h, w):
            seen = first[k][h]
            direct = max(n[k][h, w] - d, 0) / seen if seen else 0
            return direct + (d * fan[k][h] / seen if seen else 1) * word(k, w)

        self.words = {w: math.log(word(1, w) / word(0, w)) for w in vocabulary}
        self.pairs = {
            p: math.log(pair(1, *p) / word(1, p[1])) - math.log(pair(0, *p) / word(0, p[1]))
            for p in set(n[0]) | set(n[1])
            if far([n[0][p], n[1][p]])
        }

    def mean(self, text):
        found = pairs_of(text)
        return sum(self.words.get(w, 0) + self.pairs.get((h, w), 0) for h, w in found) / max(len(found), 1)


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 3 == 1


def plain_scores(spark, rows, labels, params):
    known = {}
    for i, toxic in labels:
        if i is not None and toxic is not None and not held_out(i):
            known[i] = max(toxic, known.get(i, 0))
    ids = spark.createDataFrame([(i,) for i in known], "i long")
    folds = {r["i"]: r["f"] for r in ids.select("i", F.pmod(F.xxhash64("i"), F.lit(2)).alias("f")).collect()}
    by_text = {}
    for i, text in rows:
        if i in known:
            one = (i, known[i], folds[i])
            by_text[text or ""] = min(one, by_text.get(text or "", one))
    sample = [(t, toxic, fold) for t, (_, toxic, fold) in by_text.items()]
    vocabulary = {w for t, _, _ in sample for w in words(t)}
    texts = [t for _, t in rows]
    models = [Plain([(t, k) for t, k, f in sample if f != left], texts, vocabulary, params) for left in (0, 1)]
    means, kinds = zip(*((models[f].mean(t), k) for t, k, f in sample))
    slope, shift = _curve(np.array(means), np.array(kinds))
    whole = Plain([(t, k) for t, k, _ in sample], texts, vocabulary, params)
    return [(i, 1 / (1 + math.exp(-(whole.mean(t) * slope + shift)))) for i, t in rows]


@pytest.mark.parametrize("factor, discount", [(16.0, 0.75), (3.0, 0.4)])
def test_scores_equal_plain_models(spark, monkeypatch, factor, discount):
    draw = random.Random(5)
    rude = ["zorg", "blat", "vex"]
    rows, labels = [], []
    for i in range(160):
        parts = prose(i, 40, 60).split()
        toxic = i % 4 == 0
        for _ in range(6 * toxic):
            parts.insert(draw.randrange(len(parts)), draw.choice(rude))
        rows.append((i, " ".join(parts)))
        if i % 5:
            labels.append((i, int(toxic)))
    rows += [(500 + i, t) for i, (_, t) in enumerate(edge_rows()) if t is None or len(t) < 1_000]
    rows += [(3, rows[3][1]), (700, rows[4][1]), (None, "zorg vex zorg")]
    labels += [(4, 0), (8, None), (None, 1), (700, 0), (500, 0)]
    params = Toxicity(factor=factor, discount=discount)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    every = len({p for _, t in rows for p in pairs_of(t)})
    guesses = []
    monkeypatch.setattr(module, "estimated", lambda registers: guesses.append(real(registers)) or every)
    found = toxicity(table(spark, rows), known, params).collect()
    assert guesses == [pytest.approx(every, rel=0.03)]
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.score) for r in found))
    want = sorted((i is None, i or 0, s) for i, s in plain_scores(spark, rows, labels, params))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    off = [(g, w) for g, w in zip(got, want) if abs(g[2] - w[2]) > 1e-9]
    assert off == []
    assert max(g[2] for g in got) > 0.9 and min(g[2] for g in got) < 0.1

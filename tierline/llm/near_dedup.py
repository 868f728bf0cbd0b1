"""Near duplicates: ProbMinHash over weighted word shingles, banding, verification.

The shingles of a text, weighted by how often they occur, each send a Poisson
process of arrivals, with the weight as its rate and every arrival at a random
component of the signature; a component keeps the shingle that arrived first. Two
texts agree in a component with the probability Jaccard similarity J_P of their
shingles. A shingle's process ends as soon as it is later than all components, so
most shingles of a long text need one arrival.

Bands of the signature give buckets. In a bucket not all pairs become rows: texts
are verified against a leader, with the exact J_P of the whole texts, and links give
components. Where a bucket still holds more than one component, its texts outside
of the largest one are compared with all that are in another component, in blocks of
texts against blocks of texts. So a large group of copies costs about one comparison
a member, and no link between components that the bands show goes untested.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm import arrays
from tierline.llm.common import quoted, require_columns, stored
from tierline.llm.components import components

#: Ids are below; from here on numbers stand for documents without one.
NO_ID = 1 << 62


@dataclass(frozen=True)
class NearDuplicates:
    """Parameters.

    With 66 bands of 9, a pair at 0.8 shares no bucket once in 13,500, one at 0.85
    once in 35 million. Bands this long keep texts apart that share a passage which
    is half of each: at 0.4 a pair meets once in 58. Blocks bound what a task holds
    while it compares texts of a bucket, and change no result.
    """

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 66
    rows: int = 9
    block_texts: int = 64
    block_bytes: int = 1 << 22


def near_duplicates(
    docs: DataFrame,
    params: NearDuplicates = NearDuplicates(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A row per row of ``docs``: its id and ``class_id``, the smallest id of its class.

    Texts are in one class if a chain of links joins them. Equal word sequences are
    linked, and texts with J_P of ``threshold`` or more over runs of ``shingle``
    words. A shorter text is one shingle. Words are ``[^\\x20\\x09-\\x0D]+``.

    * All texts without words (null, empty, blank) are one class.
    * Rows that repeat an id are one document with several texts: the links of
      each are its links. A row with a null id is a document of its own, after
      all others; a class of such documents alone has a null id.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    text = F.coalesce(quoted(text_column), F.lit(""))
    rows = docs.select(
        F.coalesce(quoted(id_column).cast("long"), _stand_in(text)).alias("doc"),
        text.cast("binary").alias("text"),
    )
    members, hits = _bucketed(rows, params)
    # Whole texts, of those documents that share a bucket.
    wanted = hits.select("doc").distinct()
    texts = stored(rows.join(wanted.hint("merge"), "doc"), "near-texts")
    links = _leader_links(hits.select("key", "doc", "leader"), texts, params)
    links = stored(links.unionByName(_same_document(members)), "near-links")
    labels = components(links)
    more = stored(_block_links(_mixed(hits, labels), texts, params), "near-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    named = members.join(labels, members["copy_of"] == labels["node"], "left")
    known = lambda c: F.when(c < NO_ID, c)
    return named.select(
        known(F.col("doc")).alias(id_column),
        known(F.coalesce("label", "copy_of")).alias("class_id"),
    )


def _stand_in(text: Column) -> Column:
    """For a null id: a number after all ids, the same for the same text."""
    return F.lit(NO_ID) + F.pmod(F.xxhash64(text), F.lit(NO_ID - 1))


def _same_document(members: DataFrame) -> DataFrame:
    """Links between the texts of one id; few ids have more than one."""
    several = members.groupBy("doc").agg(
        F.min("copy_of").alias("a"), F.max("copy_of").alias("last")
    ).filter("a <> last")
    return members.join(several, "doc").select("a", F.col("copy_of").alias("b")).filter("a <> b").distinct()


def _bucketed(rows: DataFrame, params: NearDuplicates) -> tuple[DataFrame, DataFrame]:
    """Each document with the one it copies, and the buckets of two texts or more.

    Copies (equal words) are put together first, so that a bucket holds different
    texts only. A document that has copies under several texts stands for the first.
    """
    signed = stored(
        rows.mapInArrow(
            lambda b: _signatures(b, params), "doc long, one long, two long, bands array<long>"
        ),
        "near-signatures",
    )
    copies = signed.groupBy("one", "two").agg(F.min("doc").alias("copy_of"))
    members = stored(
        signed.join(copies, ["one", "two"]).select(
            "doc", "copy_of", F.when(F.col("doc") == F.col("copy_of"), F.col("bands")).alias("bands")
        ),
        "near-members",
    )
    keys = members.select(F.explode("bands").alias("key"), "doc")
    buckets = (
        keys.groupBy("key")
        .agg(F.min("doc").alias("leader"), F.max("doc").alias("last"))
        .filter("leader <> last")
        .select("key", "leader")
    )
    hits = stored(keys.join(buckets, "key").distinct(), "near-buckets")
    return members.select("doc", "copy_of"), hits


def _leader_links(hits: DataFrame, texts: DataFrame, params: NearDuplicates) -> DataFrame:
    return _verified(_pairs(hits.select(F.col("leader").alias("a"), F.col("doc").alias("b"))),
                     texts, params)


def _pairs(found: DataFrame) -> DataFrame:
    ordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.filter("a <> b").distinct()


def _mixed(hits: DataFrame, labels: DataFrame) -> DataFrame:
    """The buckets that hold texts of more than one component, with the labels.

    In a bucket of two there is no pair but that with the leader. Of buckets that
    hold the same texts, in several bands, one is enough; sets of texts are told
    apart by two 64-bit sums of hashes.
    """
    labelled = hits.join(labels, hits["doc"] == labels["node"], "left").select(
        "key", "doc", "leader", F.coalesce("label", "doc").alias("label")
    )
    mixed = (
        labelled.groupBy("key")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.count(F.lit(1)).alias("n"),
            F.bit_xor(F.xxhash64("doc")).alias("one"),
            F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("two"),
        )
        .filter("low <> high and n > 2")
        .groupBy("n", "one", "two")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    return labelled.join(mixed, "key")


def _block_links(hits: DataFrame, texts: DataFrame, params: NearDuplicates) -> DataFrame:
    """Links across the components of a bucket.

    The texts outside of a bucket's largest component, and all of its texts, are
    dealt to blocks that are bounded in texts and bytes; a row is a pair of blocks.
    """
    held = hits.join(texts.withColumn("size", F.octet_length("text")), "doc")
    held = stored(held.select("key", "doc", "label", "text", "size"), "near-mixed")
    sizes = held.groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")
    )
    buckets = sizes.groupBy("key").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"),
        F.greatest(
            F.ceil(F.sum("n") / params.block_texts), F.ceil(F.sum("bytes") / params.block_bytes)
        ).alias("blocks"),
    )
    marked = held.join(buckets, "key").withColumn(
        "block", F.pmod(F.xxhash64("doc"), F.col("blocks"))
    )
    text = F.struct("doc", "label", "text")
    all_ = marked.groupBy("key", "block").agg(F.collect_list(text).alias("all"))
    few = marked.filter("label <> main").groupBy("key", "block").agg(
        F.collect_list(text).alias("few")
    )
    both = few.select("key", "few").join(all_.select("key", "all"), "key").select("few", "all")
    return both.mapInArrow(lambda x: _similar_blocks(x, params), "a long, b long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, params: NearDuplicates) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    with_b = pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("b_text")), "b")
    with_a = with_b.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("a_text")), "a")
    both = with_a.select("a", "b", "a_text", "b_text")
    return both.mapInArrow(lambda x: _similar(x, params), "a long, b long").distinct()


# --- in tasks --------------------------------------------------------------


@dataclass(frozen=True)
class Shingles:
    """Distinct shingles of all rows, sorted by row: hash and count of each."""

    row: np.ndarray
    hash: np.ndarray
    weight: np.ndarray
    first: np.ndarray


def shingles_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[Shingles, arrays.Words]:
    w = arrays.words(data, offsets)
    counts = np.diff(w.first)
    rows = len(counts)
    factors = arrays.powers(length + 1, np.uint64(0x8CB92BA72F3D8DD7))[1:]
    n = max(len(w.hash) - length + 1, 0)
    runs = np.zeros(n, dtype=np.uint64)
    for j in range(length):
        runs += w.hash[j : n + j] * factors[j]
    runs = arrays.mixed(runs)
    of_word = np.repeat(np.arange(rows), counts)
    whole = of_word[:n] == of_word[length - 1 : length - 1 + n] if n else np.empty(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < length))
    # A text shorter than a shingle is one: the words of the short rows, row by row.
    of_short = np.isin(of_word, short)
    begins = np.concatenate(([0], np.cumsum(counts[short])[:-1])) if len(short) else short
    row = np.concatenate((of_word[:n][whole], short))
    hashes = np.concatenate((runs[whole], arrays.hash_runs(w.hash[of_short], begins, 3)))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(row)))
    row = row[at]
    return Shingles(row, hashes[at], weight, np.searchsorted(row, np.arange(rows + 1))), w


def signatures(s: Shingles, rows: int, size: int) -> np.ndarray:
    """A signature of ``size`` shingle hashes for each row; 0 for a row without shingles."""
    arrived = np.full(rows * size, np.inf)
    kept = np.zeros(rows * size, dtype=np.uint64)
    row, state, rate = s.row, arrays.mixed(s.hash), s.weight.astype(np.float64)
    shingle, time = s.hash, np.zeros(len(row))
    step = np.uint64(0x9E3779B97F4A7C15)
    while len(row):
        state = arrays.mixed(state + step)
        # 53 bits for the waiting time, others for the component.
        share = ((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        time = time - np.log(share) / rate
        component = (arrays.mixed(state ^ step) % np.uint64(size)).astype(np.int64)
        at = row * size + component
        np.minimum.at(arrived, at, time)
        won = arrived[at] == time
        kept[at[won]] = shingle[won]
        # Rows are sorted: the latest component of those that are still at work.
        some = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        latest = arrived.reshape(rows, size)[row[some]].max(axis=1)
        last = np.repeat(latest, np.diff(np.append(some, len(row))))
        going = time < last
        row, state, rate = row[going], state[going], rate[going]
        shingle, time = shingle[going], time[going]
    return kept.reshape(rows, size)


def _signatures(
    batches: Iterator[pa.RecordBatch], params: NearDuplicates
) -> Iterator[pa.RecordBatch]:
    size = params.bands * params.rows
    for batch in arrays.portions(batches, 1):
        rows = batch.num_rows
        s, w = shingles_of(*arrays.texts_of(batch.column(1)), params.shingle)
        signature = signatures(s, rows, size).reshape(rows, params.bands, params.rows)
        factors = arrays.powers(params.rows + 1, np.uint64(0xC2B2AE3D27D4EB4F))[1:]
        bands = arrays.mixed((signature * factors).sum(axis=2, dtype=np.uint64))
        bands = arrays.mixed(bands + np.arange(params.bands, dtype=np.uint64))
        some = np.diff(s.first) > 0
        filled = np.flatnonzero(np.diff(w.first) > 0)
        keys = []
        for seed in (4, 5):
            key = np.zeros(rows, dtype=np.uint64)
            key[filled] = arrays.hash_runs(w.hash, w.first[:-1][filled], seed)
            keys.append(pa.array(key.view(np.int64)))
        # A text without words has no bucket.
        ends = np.concatenate(([0], np.cumsum(some * params.bands))).astype(np.int32)
        lists = pa.ListArray.from_arrays(
            pa.array(ends), pa.array(bands[some].reshape(-1).view(np.int64))
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *keys, lists], ["doc", "one", "two", "bands"]
        )


def probability_jaccard(x_hash, x_weight, y_hash, y_weight) -> float:
    """Sum over common i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    union = np.union1d(x_hash, y_hash)
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, x_hash)] = x_weight
    y[np.searchsorted(union, y_hash)] = y_weight
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    # x_j / x_i is the larger one exactly where y_j / x_j is no larger than y_i / x_i.
    ratio = np.divide(y, x, out=np.full(len(x), np.inf), where=x > 0)
    order = np.argsort(ratio, kind="stable")
    ranks = np.searchsorted(ratio[order], ratio[both], side="right")
    below = np.concatenate(([0.0], np.cumsum(x[order])))[ranks]
    above = np.concatenate((np.cumsum(y[order][::-1])[::-1], [0.0]))[ranks]
    return float(np.sum(1.0 / (below / x[both] + above / y[both])))


def _similar(
    batches: Iterator[pa.RecordBatch], params: NearDuplicates
) -> Iterator[pa.RecordBatch]:
    for batch in arrays.portions(batches, 2):
        (a, _), (b, _) = (
            shingles_of(*arrays.texts_of(batch.column(k)), params.shingle) for k in (2, 3)
        )
        good = []
        for i in range(batch.num_rows):
            x, y = slice(a.first[i], a.first[i + 1]), slice(b.first[i], b.first[i + 1])
            found = probability_jaccard(a.hash[x], a.weight[x], b.hash[y], b.weight[y])
            # The sum of many quotients may be an ulp or two short of the threshold.
            good.append(found >= params.threshold - 1e-12)
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))


class Joined:
    """Which components the links of a task have joined so far."""

    #: Components that are remembered; without them links are found again, and none is lost.
    MOST = 1 << 20

    def __init__(self):
        self._up: dict[int, int] = {}

    def root(self, label: int) -> int:
        up, last = self._up, label
        while last in up:
            last = up[last]
        while label != last:  # shorter for the next one
            up[label], label = last, up[label]
        return last

    def roots(self, labels: np.ndarray) -> np.ndarray:
        different, place = np.unique(labels, return_inverse=True)
        return np.array([self.root(x) for x in different.tolist()], dtype=np.int64)[place]

    def join(self, one: int, two: int) -> bool:
        """Whether the two were apart until now."""
        one, two = self.root(one), self.root(two)
        if one == two:
            return False
        if len(self._up) >= self.MOST:
            self._up.clear()
        self._up[max(one, two)] = min(one, two)
        return True


def _similar_blocks(
    batches: Iterator[pa.RecordBatch], params: NearDuplicates
) -> Iterator[pa.RecordBatch]:
    """Links from texts of the first block to other components in the second.

    Components that a link of this task has joined, in this bucket or another, are one
    from then on: a further link between them says nothing new and is not looked for.
    """
    joined = Joined()
    for batch in batches:
        for i in range(batch.num_rows):
            few, rest = (batch.column(k)[i].values for k in (0, 1))
            docs, labels = (
                np.concatenate([x.field(name).to_numpy() for x in (few, rest)])
                for name in ("doc", "label")
            )
            n, roots = len(few), joined.roots(labels)
            open_ = roots[:n, None] != roots[None, n:]
            if not open_.any():
                continue
            column = pa.concat_arrays([few.field("text"), rest.field("text")])
            s, _ = shingles_of(*arrays.texts_of(column), params.shingle)
            sure, maybe = _candidates(s, n, open_, params.threshold)
            names = labels.tolist()
            found = [(x, y) for x, y in zip(*sure) if joined.join(names[x], names[n + y])]
            for x, y in zip(*maybe):
                apart = joined.root(names[x]) != joined.root(names[n + y])
                if apart and _reaches(s, x, n + y, params.threshold):
                    joined.join(names[x], names[n + y])
                    found.append((x, y))
            x, y = np.array(found, dtype=np.int64).reshape(-1, 2).T
            a, b = docs[x], docs[n + y]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"]
            )


def similar_pairs(s: Shingles, n: int, wanted: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the first ``n`` rows and which of the others have J_P of the threshold."""
    sure, maybe = _candidates(s, n, wanted, threshold)
    result = np.zeros(wanted.shape, dtype=bool)
    result[sure] = True
    for i, j in zip(*maybe):
        result[i, j] = _reaches(s, i, n + j, threshold)
    return result


def _reaches(s: Shingles, i: int, j: int, threshold: float) -> bool:
    x, y = slice(s.first[i], s.first[i + 1]), slice(s.first[j], s.first[j + 1])
    found = probability_jaccard(s.hash[x], s.weight[x], s.hash[y], s.weight[y])
    # The sum of many quotients may be an ulp or two short of the threshold.
    return found >= threshold - 1e-12


def _candidates(
    s: Shingles, n: int, wanted: np.ndarray, threshold: float
) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Wanted pairs with J_P of the threshold, and those for which it is to be worked out.

    With all weights 1, J_P is the share of common shingles, a product of two 0-1
    matrices. For other texts the weight that lies on common shingles bounds J_P,
    and it is worked out where the bound allows.
    """
    rows = len(s.first) - 1
    total = np.bincount(s.row, weights=s.weight, minlength=rows)
    values, place = np.unique(s.hash, return_inverse=True)
    left = s.row < n
    # Only shingles of both sides count.
    sides = np.zeros((2, len(values)), dtype=bool)
    sides[0, place[left]] = sides[1, place[~left]] = True
    number = np.cumsum(sides.all(axis=0)) - 1
    chosen = sides.all(axis=0)[place]
    row, column = s.row[chosen], number[place[chosen]]
    share = (s.weight / np.maximum(total, 1)[s.row])[chosen]
    common, mass = np.zeros((n, rows - n)), [np.zeros((n, rows - n)) for _ in range(2)]
    plain = np.ones(rows, dtype=bool)
    plain[s.row[s.weight > 1]] = False
    # No wider than there are shingles of both sides: most blocks share a few thousand.
    columns = int(number[-1]) + 1 if len(number) else 0
    width = max(1, min(columns, (1 << 24) // rows))
    for low in range(0, columns, width):
        some = (column >= low) & (column < low + width)
        seen = np.zeros((rows, width), dtype=np.float32)
        seen[row[some], column[some] - low] = 1
        common += seen[:n] @ seen[n:].T
        if not plain.all():
            weight = np.zeros((rows, width), dtype=np.float32)
            weight[row[some], column[some] - low] = share[some]
            mass[0] += weight[:n] @ seen[n:].T
            mass[1] += seen[:n] @ weight[n:].T
    count = np.diff(s.first)
    union = count[:n, None] + count[None, n:] - common
    result = wanted & (common >= (threshold - 1e-12) * union) & (common > 0)
    weighted = wanted & ~(plain[:n, None] & plain[None, n:])
    result &= ~weighted
    # The sums are in single precision.
    maybe = weighted & (np.minimum(*mass) >= threshold - 1e-3)
    return np.nonzero(result), np.nonzero(maybe)

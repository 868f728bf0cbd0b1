"""Packing documents into training sequences by the sum-of-squares rule.

Online packing: of the fill levels at which a window is open, a document goes into
the one that leaves the smallest sum of squared counts of partially filled
windows over all levels. The counts stand in a level array, so placing a document
is one pass over that array, whatever the number of documents.

Every task packs the rows it reads; nothing is shuffled. A document longer than a
window fills whole windows first, and only its rest is placed. What is open at
the end of a task is joined and cut anew, so that a task leaves one window at
most with much padding.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import quoted, require_columns

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


@dataclass(frozen=True)
class Packing:
    """Parameters.

    ``end_id`` closes every document. Windows filled to ``good_fill`` or more are
    left as they are at the end of a task. ``open_windows`` bounds the memory: with
    more of them open, all are closed as at the end.
    """

    tokenizer: str
    length: int = 2048
    end_id: int = 1
    good_fill: float = 0.98
    open_windows: int = 4096


def pack(
    docs: DataFrame, params: Packing, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row per piece of a document: where it stands in which sequence.

    Columns as in ``PIECES``. ``start`` counts the document's ids before the piece
    and ``offset`` those of the sequence; ``ids_crc32`` is over the ids as
    little-endian 32-bit numbers. Ids of sequences are unique, not consecutive.

    * A null or empty text has the end id alone, and so one piece.
    * Rows that repeat an id are packed each; a null id stays null.
    * A text of any length is tokenised whole, in parts between white space.
    * An empty table gives an empty result; other columns are not looked at.
    """
    require_columns(docs, id_column, text_column)
    rows = docs.select(
        quoted(id_column).cast("long").alias("doc_id"),
        F.coalesce(quoted(text_column), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(lambda batches: _pieces(batches, params), PIECES)


class WordTokens:
    """Ids of a text as bytes, from a tokenizer that never joins over white space.

    Such a tokenizer gives a text the ids of its white-space separated parts, one
    after the other. Parts recur, so each is looked up once for all texts of a call,
    and its ids are remembered. Parts that were not met for long are forgotten.
    """

    #: Parts after which those not met since the last time are forgotten, and the
    #: longest that is remembered in bytes.
    REMEMBERED, LONGEST = 500_000, 64
    _MARK, _AT_ONCE = b"~", 2_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._letters = _letter_tokenizer(path, self._tokenizer)
        self._closing = np.zeros(self._tokenizer.get_vocab_size(), dtype=bool)
        closing = [i for t, i in self._tokenizer.get_vocab().items() if t.endswith(_SUFFIX)]
        self._closing[closing] = True
        (self._mark_id,) = np.frombuffer(self._encode(self._MARK), dtype="<u4")

    def ids(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each text; the parts of all that are new are encoded at once."""
        plain = pa.array([_plain(text) for text in texts], pa.large_binary())
        split = pc.ascii_split_whitespace(plain.view(pa.large_string()))
        parts = split.values.dictionary_encode()
        different = list(_cut(parts.dictionary))
        found = pa.array(self._ids_of(different), pa.large_binary()).take(parts.indices)
        yield from _cut(found, split.offsets.to_numpy())

    def _ids_of(self, parts: list[bytes]) -> list[bytes]:
        """The ids of different parts."""
        if len(self._known) > self.REMEMBERED:
            self._known, self._older = {}, self._known
        found = list(map(self._known.get, parts))
        new = [part for part, ids in zip(parts, found) if ids is None]
        learnt = self._learn(new)
        self._known.update((p, ids) for p, ids in learnt.items() if len(p) <= self.LONGEST)
        return [learnt[part] if ids is None else ids for part, ids in zip(parts, found)]

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of parts that are not known, and of words in them. Closing signs are
        tokens apart, so a word with them needs no call if the word alone is known."""
        known, older, learnt, wanted, signed = self._known, self._older, {}, set(), []
        for part in new:
            if (ids := older.get(part)) is not None:
                learnt[part] = ids
                continue
            word = part.rstrip(_SIGNS)
            if word and len(word) < len(part) and b"<|" not in part and _ends_word(word):
                signed.append((part, word, part[len(word) :]))
                wanted.update(signed[-1][1:])
            else:
                wanted.add(part)
        letters, others = [], []
        for part in wanted:
            if part in learnt:
                continue
            if (ids := known.get(part)) is not None or (ids := older.get(part)) is not None:
                learnt[part] = ids
            elif len(part) > self.LONGEST or self._MARK in part:
                learnt[part] = self._encode(part)
            else:
                (letters if self._letters and _all_letters(part) else others).append(part)
        for some, encode in ((letters, self._encode_letters), (others, self._encode_marked)):
            for low in range(0, len(some), self._AT_ONCE):
                portion = some[low : low + self._AT_ONCE]
                learnt.update(zip(portion, encode(portion)))
        for part, word, signs in signed:
            learnt[part] = learnt[word] + learnt[signs]
        return learnt

    def _encode(self, text: bytes) -> bytes:
        return _ids(self._tokenizer, text.decode("utf-8", "replace")).tobytes()

    def _encode_letters(self, parts: list[bytes]) -> list[bytes]:
        """Words of plain letters as one text, cut behind the ids that close a word."""
        ids = _ids(self._letters, _as_symbols(b" ".join(parts)))
        ends = (np.flatnonzero(self._closing[ids]) + 1) * 4
        if len(ends) != len(parts):
            return self._encode_marked(parts)
        data, ends = ids.tobytes(), ends.tolist()
        return [data[low:high] for low, high in zip([0, *ends], ends)]

    def _encode_marked(self, parts: list[bytes]) -> list[bytes]:
        """The parts as one text with a mark after each, cut at the mark's id.

        That takes half the time of a call's list. No part has the mark in it.
        """
        data = self._encode((b" " + self._MARK + b" ").join(parts))
        at = np.flatnonzero(np.frombuffer(data, dtype="<u4") == self._mark_id) * 4
        if len(at) != len(parts) - 1:
            return [self._encode(p) for p in parts]
        begins = [0, *(at + 4).tolist()]
        return [data[low:high] for low, high in zip(begins, [*at.tolist(), len(data)])]


def _cut(values: pa.Array, at: np.ndarray | None = None) -> Iterator[bytes]:
    """Values with 64-bit offsets as bytes; with places, all from each to the next together."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    ends = (offsets if at is None else offsets[at]).tolist()
    held = data.to_pybytes() if data else b""
    return (held[low:high] for low, high in zip(ends, ends[1:]))


def _ids(tokenizer, text: str) -> np.ndarray:
    (found,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
    return np.array(found.ids, dtype="<u4")


#: What closes the last token of a word, and the steps before the model of a tokenizer
#: that leaves lower-case letters as they are and never splits between them.
_SUFFIX = "</w>"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _letter_tokenizer(path: str, tokenizer):
    """The tokenizer's model alone, for words of letters; None if its other steps are unknown.

    Composing, lowering case and splitting change nothing in such words, and are two
    thirds of the time that encoding takes.
    """
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    before = (told.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    if (
        (told.get("normalizer") or {}).get("normalizers") != _NORMALIZERS
        or [step.get("type") for step in before] != ["Split", "ByteLevel"]
        or before[0].get("pattern") != {"Regex": _SPLIT}
        or before[1].get("add_prefix_space")
        or before[1].get("use_regex")
        or told["model"].get("type") != "BPE"
        or told["model"].get("end_of_word_suffix") != _SUFFIX
        or told["model"].get("dropout")
    ):
        return None
    letters = Tokenizer(tokenizer.model)
    letters.pre_tokenizer = CharDelimiterSplit(" ")
    return letters


#: Words of a to z and the lower-case letters of Latin-1 that are two bytes from C3.
_all_letters = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch

#: Of the bytes in such words, those that the model's symbols are not the same number for.
_SYMBOLS = {"\x9f": "\u0141", "\xa0": "\u0142", "\xad": "\u0143"}


def _as_symbols(words: bytes) -> str:
    """Words of letters as a byte-level model knows them, a character for each byte."""
    text = words.decode("latin-1")
    for byte, symbol in _SYMBOLS.items():
        text = text.replace(byte, symbol)
    return text


def _plain(text: bytes) -> bytes:
    """The text with fewer different parts, and the same ids.

    The tokenizer lowers case itself, after composing accents. So a text with
    combining accents (lead bytes CC, CD), or one that may hold special tokens,
    which are matched as written, keeps its case.
    """
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text
    return text.lower()


#: ASCII signs but for the apostrophe and the mark.
_SIGNS = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}'


def _ends_word(part: bytes) -> bool:
    """Whether the last character is an ASCII letter or digit, or a letter of Latin-1."""
    last = part[-1]
    if last < 0x80:
        return part[-1:].isalnum()
    return len(part) > 1 and part[-2] == 0xC3 and last not in (0x97, 0xB7)  # not the signs x and :


@lru_cache(maxsize=1)
def _tokens(path: str) -> WordTokens:
    """One for each Python worker, which runs many tasks."""
    return WordTokens(path)


class SumOfSquares:
    """Open windows by fill level, and the choice among the levels."""

    def __init__(self, length: int):
        self.length = length
        self.count = 0
        self._levels = np.zeros(length + 1, dtype=np.int64)
        # What the sum grows by when a window arrives at a level. A full window
        # is closed and counts no more.
        self._arrive = np.ones(length + 1, dtype=np.int64)
        self._arrive[length] = 0
        self._windows: dict[int, list[list]] = {}

    def place(self, piece: tuple, size: int) -> list | None:
        """Put a piece into a window; the window, if that fills it."""
        levels = self._levels[1 : self.length - size + 1]
        # Leaving level h changes the sum by 1 - 2 levels[h].
        change = self._arrive[size + 1 :] + 1 - 2 * levels
        change[levels == 0] = np.iinfo(np.int64).max
        level, least = 0, self._arrive[size]
        if len(change):
            # Of equal levels the fullest: the last one.
            best = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[best] <= least:
                level = best + 1
        window = self._take(level)
        window.append(piece)
        if level + size == self.length:
            return window
        self._move(level + size, 1)
        self._windows.setdefault(level + size, []).append(window)
        return None

    def close(self) -> list[tuple[int, list]]:
        """All open windows with their levels, the fullest first."""
        found = [(h, w) for h in sorted(self._windows, reverse=True) for w in self._windows[h]]
        self.__init__(self.length)
        return found

    def _take(self, level: int) -> list:
        if level == 0:
            return []
        self._move(level, -1)
        return self._windows[level].pop()

    def _move(self, level: int, by: int) -> None:
        self.count += by
        self._levels[level] += by
        self._arrive[level] += 2 * by


def _pieces(batches: Iterator[pa.RecordBatch], params: Packing) -> Iterator[pa.RecordBatch]:
    tokens = _tokens(params.tokenizer)
    task = TaskContext.get()
    packer = _Packer(params, (task.partitionId() if task else 0) << 33)
    # Nothing here makes cycles, and the collector would walk all parts again and again.
    collecting = gc.isenabled()
    gc.disable()
    try:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for low, high in _portions(texts):
                some = (texts[i].as_py() for i in range(low, high))
                for i, found in zip(range(low, high), tokens.ids(some)):
                    packer.add(ids[i].as_py(), found)
            yield packer.rows()
        packer.flush()
        yield packer.rows()
    finally:
        if collecting:
            gc.enable()


def _portions(texts: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes of text."""
    low, size = 0, 0
    for i in range(len(texts)):
        size += texts[i].as_buffer().size
        if size >= most:
            yield low, i + 1
            low, size = i + 1, 0
    if low < len(texts):
        yield low, len(texts)


class _Packer:
    """Cuts documents to pieces, packs them, and gathers the rows."""

    def __init__(self, params: Packing, first_sequence: int):
        self._params = params
        self._end = np.array([params.end_id], dtype="<u4").tobytes()
        self._open = SumOfSquares(params.length)
        self._sequence = first_sequence
        self._rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        data, length = memoryview(ids + self._end), self._params.length
        size = len(data) // 4
        whole = size - size % length
        for start in range(0, whole, length):
            self._emit([(doc_id, start, data[4 * start : 4 * (start + length)], size)])
        if whole < size:
            # A copy, so that an open window doesn't hold the whole document.
            piece = (doc_id, whole, memoryview(bytes(data[4 * whole :])), size)
            if full := self._open.place(piece, size - whole):
                self._emit(full)
        if self._open.count > self._params.open_windows:
            self.flush()

    def flush(self) -> None:
        """Close all open windows; join those that have much room and cut anew."""
        length = self._params.length
        window: list[tuple] = []
        room = length
        for level, pieces in self._open.close():
            if level >= self._params.good_fill * length:
                self._emit(pieces)
                continue
            for doc_id, start, data, size in pieces:
                while len(data):
                    part = data[: 4 * room]
                    window.append((doc_id, start, part, size))
                    start, data, room = start + len(part) // 4, data[4 * room :], room - len(part) // 4
                    if not room:
                        self._emit(window)
                        window, room = [], length
        if window:
            self._emit(window)

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, data, size in pieces:
            n = len(data) // 4
            self._rows.append((doc_id, start, n, zlib.crc32(data), size, self._sequence, offset))
            offset += n
        self._sequence += 1

    def rows(self) -> pa.RecordBatch:
        names = [field.split()[0] for field in PIECES.split(", ")]
        columns = zip(*self._rows) if self._rows else [[]] * len(names)
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
        self._rows = []
        return batch

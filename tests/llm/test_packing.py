import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.common import edge_rows, prose, table
from tierline.llm.packing import Packing, SumOfSquares, WordTokens, pack
from tierline.llm.queries import tokenizer_path

ODD = [
    "ä b\xa0c\x1cd <|endoftext|>x <|startoftext|>, foo bar it's DON'T",
    "İstanbul ΑΣ ΑΣ\ńx J̌ J̌, K̇. İ,",
    "a., b .. c., d!? e! <|ENDOFTEXT|>, THE!! of%%% ~ a~b ~, x~",
    "日本 語テ キスト 123 4.5 y ́ ×, ÷. é, Ü!",
    "x" * 300 + " " + "ab, " * 5,
    "",
    " \n\t ",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def expected(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_of_parts_are_the_ids_of_the_text(tokenizer):
    tokens = WordTokens(tokenizer_path())
    texts = ODD + [r[1] or "" for r in edge_rows()]
    for text, found in zip(texts, tokens.ids([t.encode() for t in texts])):
        assert np.frombuffer(found, "<u4").tolist() == expected(tokenizer, text)[:-1], text[:50]


@pytest.mark.parametrize("length, open_windows", [(2048, 4096), (64, 4096), (16, 2)])
def test_pieces_hold_each_id_once_and_fill_sequences(spark, tokenizer, length, open_windows):
    rows = edge_rows() + [(100 + i, t) for i, t in enumerate(ODD)]
    rows += [(200 + i, prose(i, 3 + 7 * i % 90)) for i in range(200)]
    params = Packing(tokenizer_path(), length=length, open_windows=open_windows)
    found = pack(table(spark, rows).coalesce(2), params).collect()
    ids = [expected(tokenizer, r[1]) for r in rows]
    wanted = sorted(
        (np.array(x, "<u4").tobytes() for x in ids), key=len
    )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in found:
        pieces[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    by_id = defaultdict(list)
    for r, x in zip(rows, ids):
        by_id[r[0]].append(x)
    for key, own in by_id.items():
        assert sum(p.length for p in pieces[key]) == sum(map(len, own))
        if len(own) > 1:
            continue
        start = 0
        for p in sorted(pieces[key], key=lambda p: p.start):
            assert p.start == start and p.doc_tokens == len(own[0])
            data = np.array(own[0][start : start + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(data)
            start += p.length
        assert start == len(own[0])
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= length
    total = sum(len(w) // 4 for w in wanted)
    # At most one window of each task is mostly padding.
    assert len(sequences) * length <= total / 0.97 + 2 * length


def test_pieces_go_where_the_sum_of_squares_is_least():
    rng, length = np.random.default_rng(1), 12
    open_ = SumOfSquares(length)
    levels = [0] * (length + 1)
    for n, size in enumerate(rng.integers(1, length, 400).tolist()):

        def after(h):
            new = list(levels)
            if h:
                new[h] -= 1
            new[h + size] += 1
            return sum(x * x for x in new[1:length])

        choices = [h for h in range(length - size + 1) if h == 0 or levels[h]]
        least = min(map(after, choices))
        full = open_.place((n,), size)
        # Which level it went to shows in the levels afterwards.
        now = open_._levels.tolist()
        moved = [h for h in choices if all(
            (levels[k] - (k == h and h > 0) + (k == h + size and k < length)) == now[k]
            for k in range(1, length)
        )]
        assert moved and after(moved[0]) == least
        assert (full is not None) == (moved[0] + size == length)
        levels = now


#: All letters whose words the model alone is asked for.
LETTERS = [chr(c) for c in [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]]


def test_words_of_letters_take_the_model_alone_and_have_the_same_ids(tokenizer, monkeypatch):
    rng = np.random.default_rng(2)
    words = LETTERS + ["".join(rng.choice(LETTERS, 1 + n % 12)) for n in range(3_000)]
    texts = [" ".join(words[n : n + 50]) for n in range(0, len(words), 50)]
    tokens, asked = WordTokens(tokenizer_path()), []
    monkeypatch.setattr(tokens, "_encode_marked", lambda parts: asked.extend(parts) or [b""] * len(parts))
    for text, found in zip(texts, tokens.ids([t.encode() for t in texts])):
        assert np.frombuffer(found, "<u4").tolist() == expected(tokenizer, text)[:-1], text
    assert asked == []


def test_parts_that_recur_are_not_forgotten(tokenizer, monkeypatch):
    tokens, asked = WordTokens(tokenizer_path()), []
    tokens.REMEMBERED = 20
    for name in ("_encode_letters", "_encode_marked"):
        encode = getattr(tokens, name)
        monkeypatch.setattr(tokens, name, lambda parts, f=encode: asked.extend(parts) or f(parts))
    for n in range(30):
        texts = [f"often {n} a{n}b&& " + " ".join(f"w{n}x{k}" for k in range(9)), "", " often  "]
        for text, found in zip(texts, tokens.ids([t.encode() for t in texts])):
            assert np.frombuffer(found, "<u4").tolist() == expected(tokenizer, text)[:-1], text
    assert asked.count(b"often") == 1
    assert len(tokens._known) + len(tokens._older) < 100


def test_no_text_and_bytes_that_are_no_utf8():
    tokens = WordTokens(tokenizer_path())
    assert list(tokens.ids([])) == [] and list(tokens.ids([b"", b" \x0b "])) == [b"", b""]
    (found,) = tokens.ids([b"a\xffb \xfe"])
    assert found == tokens._encode(b"a\xffb") + tokens._encode(b"\xfe")


def test_empty_table(spark):
    assert pack(table(spark, []), Packing(tokenizer_path())).count() == 0

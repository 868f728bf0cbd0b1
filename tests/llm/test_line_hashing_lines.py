"""Repeated lines go at any length; the minimum holds inside lines with something new."""

from collections import defaultdict

from tests.llm.common import prose, table
from tests.llm.test_line_hashing import rows, units
from tierline.llm.line_hashing import LineHashing, drop_repeated_units


def brute(data, least):
    """(id, kept bytes) of each row."""
    last = max([i for i, _ in data if i is not None]) + 1
    place = lambda i: last if i is None else i
    owner = defaultdict(lambda: last)
    for i, text in data:
        for _, w in units(text):
            owner[w] = min(owner[w], place(i))
    result = []
    for i, text in data:
        raw, own, seen, again = (text or "").encode(), units(text), set(), []
        for _, w in own:
            again.append(owner[w] != place(i) or w in seen)
            seen.add(w)
        line = [raw[:s].count(b"\n") for s, _ in own]
        new = {n for n, g in zip(line, again) if not g}
        run = [0] * len(own)
        for k in range(len(own)):
            low = high = k
            while low and again[low - 1]:
                low -= 1
            while high < len(own) and again[high]:
                high += 1
            run[k] = sum(len(w) for _, w in own[low:high])
        edges = [s for s, _ in own] + [len(raw)]
        kept = raw[: edges[0]]
        for k in range(len(own)):
            if not (again[k] and (line[k] not in new or run[k] >= least)):
                kept += raw[edges[k] : edges[k + 1]]
        result.append((i, kept))
    return sorted(result, key=str)


def short_lines():
    found = [(k, f"{prose(k, 12, 5_000)}.\nShare this. Thanks!\n{prose(k + 50, 9, 5_000)}") for k in range(9)]
    return found + [
        (20, "Thanks! Share this."),
        (21, "Share this. Quite new here. Thanks!\nshare  THIS.\nThanks! \n\n thanks!"),
        (22, "Thanks! Share\nthis."),
    ]


def test_kept_texts_equal_brute_force(spark):
    for least in (1, 10, 40):
        data = short_lines() + [r for r in rows() if r[0] not in (8, 9)]
        found = drop_repeated_units(table(spark, data), LineHashing(least, whole_lines=True))
        got = sorted(((r.doc_id, bytes(r.kept_text)) for r in found.collect()), key=str)
        assert got == brute(data, least)


def test_short_lines_go_by_default(spark):
    found = {r.doc_id: bytes(r.kept_text) for r in drop_repeated_units(table(spark, short_lines())).collect()}
    assert b"Share this" in found[0] and not any(b"Share this" in found[k] for k in range(1, 9))
    assert found[20] == b""
    assert found[21] == b"Share this. Quite new here. Thanks!\n"

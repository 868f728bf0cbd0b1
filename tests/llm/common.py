"""Small tables with the cases every operator must stand."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest int"


def table(spark, rows):
    """Documents from (id, text) or (id, text, source), with columns of clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", 0, "x", 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(words))


def edge_rows():
    """Null id, null and empty texts, blanks, ties, repeated rows and a very long text."""
    long_text = prose(1, 40_000, 3_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, "one"),
        (6, prose(2, 60)),
        (6, prose(2, 60)),
        (7, prose(2, 60).replace(" ", " \n ", 5)),
        (8, long_text),
        (9, long_text + " end"),
        (None, "no id here"),
        (None, prose(2, 60)),
        (10, "ünï çödé “quotes” \U0001f600 \x1c x"),
    ]

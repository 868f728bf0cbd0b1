import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.common import edge_rows, table
from tierline.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, sha256


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    result = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        result += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(result, key=str)


def got(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str
    )


@pytest.mark.parametrize("salts", [1, 3, 16, 63])
def test_groups_equal_brute_force(spark, salts):
    rows = edge_rows() + [(100 + i, "hot  text") for i in range(200)]
    assert got(exact_duplicates(table(spark, rows), salts=salts)) == brute(rows)


def test_texts_that_share_a_digest_are_told_apart(spark):
    rows = edge_rows() + [(50 + i, f"text {i % 7}") for i in range(30)]
    poor = lambda text: F.substring(sha256(text), 1, 0)  # noqa: E731  all digests equal
    assert got(exact_duplicates(table(spark, rows), digest=poor)) == brute(rows)


def test_empty_table_and_missing_column(spark):
    assert exact_duplicates(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        exact_duplicates(table(spark, []).drop("text"))
    with pytest.raises(ValueError):
        exact_duplicates(table(spark, []), salts=64)


def test_dropping_keeps_one_row_of_each_text(spark):
    rows = edge_rows()
    docs = table(spark, rows)
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in left.collect()]
    assert sorted(texts) == sorted({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows})

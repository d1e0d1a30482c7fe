from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adoptrend.llm import exact_dedup
from tests.llm.fixtures import CLASHING, LONG, ODD, documents


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        for n, doc_id in enumerate(sorted(ids, key=lambda i: (i is None, -(i or 0)))):
            out.append((doc_id, top, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


# the second code makes nearly all chunks collide, and versions have to tell them apart
@pytest.mark.parametrize("code", [F.xxhash64, lambda c: F.pmod(F.length(c), F.lit(2)).cast("long")], ids=["hash", "colliding"])
def test_groups_equal_texts(spark, code):
    rows = ODD + [(20 + i, LONG[: 9000 + i % 2] + "tail") for i in range(6)] + [(30, LONG[:-1]), (31, "y" * 30_000)]
    got = exact_dedup.duplicates(documents(spark, rows, **CLASHING).repartition(5), code=code)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_chunks_are_the_text(spark):
    texts = [t for _, t, *_ in ODD if t] + ["a. b\n" * 5000, "no end " * 9000, "\r\n " * 700]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("chunks", exact_dedup.chunks(F.col("text")))
    for row in df.collect():
        assert "".join(row.chunks) == row.text
        assert all(len(c) <= 8193 for c in row.chunks)
    # a passage moved to another place gives mostly the same chunks
    pick = random.Random(1)
    passage = " ".join("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(2, 9))) for _ in range(4000))
    moved = spark.createDataFrame([("start. " + passage,), ("other start " * 9 + passage,)], "text string")
    one, two = (set(r[0]) for r in moved.select(exact_dedup.chunks(F.col("text"))).collect())
    assert len(one) > 50 and len(one & two) > 0.9 * len(one)


def test_deduplicate_keeps_one_row_with_all_columns(spark):
    docs = documents(spark, **CLASHING)
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    assert sorted(r.text or "" for r in found) == sorted({t or "" for _, t, *_ in ODD})
    assert {r.doc_id for r in found if r.text and r.text.startswith("one two")} == {2}


def test_no_rows(spark):
    assert exact_dedup.duplicates(documents(spark, [])).collect() == []
    assert exact_dedup.deduplicate(documents(spark, [])).collect() == []

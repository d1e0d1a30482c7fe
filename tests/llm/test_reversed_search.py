from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from adoptrend.llm import reversed_search
from adoptrend.llm.queries import QUERIES, SQL
from tests.llm.fixtures import CLASHING, ODD, documents
from tests.parity import compare, oracle

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def best(docs, items, top=20):
    read = [(i, Counter(plain_terms(t))) for i, t in docs]
    there = [c for _, c in read if c]
    n, total = len(there), sum(c.total() for c in there)
    df = Counter(t for c in there for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked[i] = min((x for x in (asked.get(i), t) if x is not None), default=None)
    out = []
    for item, text in asked.items():
        scored = []
        for doc, count in read:
            score = 0
            for t in plain_terms(text):
                if tf := count[t]:
                    m = 75 + (25 * count.total() * n) // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:top])]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    df = reversed_search.ranked(documents(spark, docs, **CLASHING, rank=1), spark.createDataFrame(items, "item_id long, text string"), **options)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark):
    items = [(1, "three word FOUR"), (2, None), (3, ""), (4, "漢字 cödé, ünï Ünï"), (None, "one"), (5, "one one two"), (5, "another"), (6, "absent"), (2**60, "twin text")]
    docs = [*ODD, (2**60 + 1, "twin"), (2**60 + 2, "twin")]
    assert found(spark, docs, items) == best(docs, items)
    assert found(spark, docs, items, top=2) == best(docs, items, 2)


def test_blocks_of_items_and_pieces_of_texts(spark, monkeypatch):
    pick = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(pick.choices(words, k=pick.randrange(80)))) for i in range(400)]
    docs += [(i, docs[0][1]) for i in range(400, 440)]  # ties
    items = [(i, ",".join(pick.choices(words, k=pick.randrange(1, 30)))) for i in range(50)]
    monkeypatch.setattr(reversed_search, "PIECE", 16)
    assert found(spark, docs, items, block_bytes=300) == found(spark, docs, items) == best(docs, items)


def test_no_rows(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, "--")], [(1, "a")]) == []


def test_terms_of_pieces(monkeypatch):
    monkeypatch.setattr(reversed_search, "PIECE", 3)
    for text in ["", " ", "a", "Ab-c dé_f" * 5, "x" * 50, " x" * 9, "漢字 Z"]:
        assert [t.decode() for part in reversed_search.terms(text.encode()) for t in part] == plain_terms(text)


def test_large_scores_stay_whole():
    index = reversed_search.Index([(0, b"a " * 3000), (1, b"a b")])
    for weight in (10, 10**7):
        index.weigh(np.array([weight, weight + 1]))
        assert index.exact == (weight == 10)
        gained = np.array([999_983, 7])
        assert index.scores(np.array([0, 1]), gained).tolist() == [3000 * weight * 999_983, weight * 999_983 + 7 * (weight + 1)]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_agrees_with_sql(spark, folder):
    verdict, note = compare(spark, oracle(folder), "op11_reversed_search", folder, QUERIES, SQL)
    assert verdict == "ok", note

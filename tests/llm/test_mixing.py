from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adoptrend.llm import mixing
from tests.llm.fixtures import CLASHING, documents


def made(n=400):
    pick = random.Random(4)
    rows = []
    for i in range(n):
        source = pick.choice(["a"] * 6 + ["b", "c", "Ä", None])
        rows.append((i, " ".join(["wörd"] * pick.choice([0, 1, 5, 30, 90])) or None, source))
    return rows


def water(sizes, weights, share, epochs):
    """Targets by sharing what is over again and again."""
    total = share * sum(sizes.values())
    target, open_ = {}, dict(weights)
    while open_:
        rest = total - sum(target.values())
        offer = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        full = [s for s in open_ if offer[s] > epochs * sizes[s]]
        if not full:
            return target | offer
        for s in full:
            target[s] = float(epochs * sizes[s])
            del open_[s]
    return target


def test_targets_epochs_and_sample(spark):
    rows = made()
    docs = documents(spark, rows, size="clash", key="clash", target=1, absent=2).repartition(4)
    got = mixing.takes(docs).collect()
    assert len(got) == len(rows)
    words = {i: len((t or "").split()) for i, t, _ in rows}
    sizes = defaultdict(int)
    for i, _, s in rows:
        sizes[s] += words[i]
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    goal = water(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5, 2)
    taken = defaultdict(int)
    for r in got:
        assert r.size == words[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source]) and r.taken in (r.epochs * r.size, (r.epochs + 1) * r.size)
        assert r.taken <= 2 * r.size and r.epochs == goal[r.source] // max(sizes[r.source], 1)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 45, "within half of the largest document"
    again = {(r.doc_id, r.taken) for r in mixing.takes(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}
    other = {(r.doc_id, r.taken) for r in mixing.takes(docs, seed="another").collect()}
    assert other != again


def test_better_documents_come_first(spark):
    rows = [(i, "a b c d e f g h i j", "s") for i in range(600)] + [(1000 + i, "z " * 10, "t") for i in range(600)]
    weight = F.when(F.col("doc_id") % 2 == 0, 8.0).otherwise(1.0)
    got = mixing.takes(documents(spark, rows), weight, share=0.5).collect()
    extra = [r.doc_id % 2 for r in got if r.taken]
    assert 0.1 < sum(extra) / len(extra) < 0.35  # a third of the odds of the others would be 0.5


def test_mixed_repeats_documents(spark):
    docs = documents(spark, made(150), **CLASHING)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    for r in mixing.takes(docs).collect():
        assert counts.get(r.doc_id, 0) * r.size == r.taken


def test_odd_rows(spark):
    got = mixing.takes(documents(spark)).collect()
    assert len(got) == 15 and all(r.taken <= 2 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert mixing.takes(documents(spark, [])).collect() == []
    assert mixing.mixed(documents(spark, [])).collect() == []
    empty = mixing.takes(documents(spark, [(1, None, "a"), (2, "", "b")])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0)] * 2

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adoptrend.llm import topk


def best(rows, every, k):
    vectors = []
    for i, x in rows:
        if i is not None and x is not None and all(v is not None and math.isfinite(v) for v in x):
            vectors.append((i, [math.floor(256 * v) for v in x]))
    asked = {}
    for i, x in vectors:
        if i % every == 0:
            asked[i] = min(asked.get(i, x), x)
    out = []
    for q, a in asked.items():
        scored = sorted((-sum(p * r for p, r in zip(a, b, strict=False)), i) for i, b in vectors if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, every=50, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("shard", F.lit("s"))
    return sorted(tuple(r) for r in topk.self_search(df, every, k).select("query_id", "rank", "vec_id", "score").collect())


def f32(x):
    return [None if v is None else float(np.float32(v)) for v in x]


def test_any_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 64)
    pick = random.Random(1)
    rows = [(i, f32([pick.gauss(0, 0.125) for _ in range(12)])) for i in range(500)]
    rows += [(i, f32([0.5, -0.25] * 6)) for i in range(500, 540)]  # ties
    rows += [(600, None), (650, []), (651, f32([1, None, 2])), (652, [float("nan")] * 12), (653, [float("inf")] * 12), (None, f32([1] * 12))]
    rows += [(700, f32([0.1] * 4)), (701, f32([3.0] * 20)), (300, f32([0.2] * 12)), (7, rows[7][1])]  # lengths, repeated ids
    assert found(spark, rows) == best(rows, 50, 5)
    assert topk.self_search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 50).columns == ["query_id", "rank", "vec_id", "score"]


def test_few_and_none(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(0, [1.0]), (3, [-1.0])]) == [(0, 1, 3, -65536)]
    assert found(spark, [(1, [1.0]), (3, [-1.0])]) == []


@pytest.mark.parametrize("scale", [1, 1 << 10, 1 << 22])
def test_shard_search_is_exact_and_skips(scale):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-50, 50, (400, 16)) * (scale if scale > 1 << 20 else 1)
    vectors[:, 0] *= scale if scale < 1 << 20 else 1
    shard = topk.Shard(np.arange(400), vectors)
    for own in range(20):
        query = vectors[own]
        exact = sorted((-int(sum(int(a) * int(b) for a, b in zip(query, v, strict=True))), i) for i, v in enumerate(vectors) if i != own)[:5]
        for least in (None, -exact[4][0], -exact[0][0]):
            ids, scores = shard.search(own, query, 5, least)
            want = [(i, -s) for s, i in exact if least is None or -s >= least]
            assert list(zip(ids, scores, strict=True))[: len(want)] == want
    # a bound no vector of the shard can reach ends the search before any term is summed
    assert len(shard.search(0, vectors[0], 5, int(np.abs(vectors).max()) ** 2 * 17)[0]) == 0


def test_queries_reach_every_area_and_nothing_is_broadcast(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(topk, "cut", lambda df, real=topk.cut: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df))
    monkeypatch.setattr(topk, "AREA", 1000, raising=False)
    pick = random.Random(3)
    rows = [(i, f32([pick.gauss(0, 0.125) for _ in range(8)])) for i in range(600)]
    rows += [(i, f32([0.75] * 8)) for i in range(600, 700)]  # ties over all areas
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").select("vec_id", topk.quantised().alias("x"))
    got = topk.top_scores(vectors, vectors.where("vec_id % 10 = 0"), 7, shard=32, block=16)
    assert sorted(tuple(r) for r in got.collect()) == best(rows, 10, 7)
    # each query goes to every area: as a side of a join they look short to the optimizer, and pass through the driver
    assert plans and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("probed", [1, 1 << 30])
@pytest.mark.parametrize("spread", [1, 1 << 12, 1 << 23])
def test_bounds_rule_out_nothing_that_is_wanted(monkeypatch, spread, probed):
    # the other terms are probed for what can compete or summed for all; the result is that of all terms at once
    monkeypatch.setattr(topk, "PROBED", probed, raising=False)
    rng = np.random.default_rng(4)
    vectors = rng.integers(-9, 9, (300, 12))
    vectors[:, :2] = rng.integers(-99, 99, (300, 2)) * spread
    shard, ids = topk.Shard(np.arange(300), vectors), np.arange(40)
    exact = vectors[:40].astype(object) @ vectors.T.astype(object)
    least = np.array([sorted(row, reverse=True)[6] for row in exact.tolist()], np.int64)
    for known in (np.ones(40, bool), np.arange(40) % 2 == 0):
        found = []
        for split in (True, False):
            at, of, scores, ruled_out = shard.reached(ids, vectors[:40], 5, least, known, split)
            assert ruled_out == (not split or probed == 1)
            assert all(exact[a][i] == s for a, i, s in zip(at.tolist(), of.tolist(), scores.tolist(), strict=True))
            found.append(sorted(zip(at.tolist(), of.tolist(), scores.tolist(), strict=True)))
        assert found[0] == found[1]
        for a in range(40):
            others = sorted(((s, i) for i, s in enumerate(exact[a].tolist()) if i != a), reverse=True)
            end = int(least[a]) if known[a] else others[4][0]
            assert sorted((s, i) for x, i, s in found[0] if x == a) == sorted((s, i) for s, i in others if s >= end)

from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from adoptrend.llm import simhash
from tests.llm.fixtures import CLASHING, ODD, documents


def plain(text, shingle=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(items, distance):
    """item -> representative, by comparing all with all; items are (id, fingerprint)."""
    parent = list(range(len(items)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(items):
        for j in range(i):
            if (a ^ items[j][1]).bit_count() <= distance:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(items))]


def test_fingerprint():
    texts = [t for _, t, *_ in ODD] + ["A b\x0bC\x1cd e", "É é É", "one", "one two", "a a a a a a", " lead and trail "]
    for text in texts:
        assert simhash.fingerprint(None if text is None else text.encode()) == plain(text), repr(text)[:80]
    assert simhash.fingerprint(b"a b c d e f", 5) == plain("a b c d e f", 5)
    block, simhash.BLOCK = simhash.BLOCK, 7
    try:
        assert simhash.fingerprint(ODD[5][1].encode()[:2000]) == plain(ODD[5][1][:2000])
    finally:
        simhash.BLOCK = block


def test_hash_is_sparks(spark):
    row = spark.createDataFrame([("ein wört mehr",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] % 2**64 == xxhash.xxh64_intdigest("ein wört mehr".encode(), 42)


def test_gray_rank(spark):
    codes = [i ^ (i >> 1) for i in range(512)] + [1 << 63, (1 << 63) | 5, 2**64 - 1]
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long").select("fp", simhash.gray_rank(F.col("fp")).alias("rank"))
    order = [r.fp for r in df.orderBy("rank").collect()]
    assert order[:512] == signed[:512]
    ranks = {r.fp % 2**64: r["rank"] + 2**63 for r in df.collect()}
    assert all(r ^ (r >> 1) == c for c, r in ranks.items())


def test_no_link_is_lost(spark, monkeypatch):
    # small leaves and a small fan, so that the tree has several levels
    monkeypatch.setattr(simhash, "LEAF", 4)
    monkeypatch.setattr(simhash, "FAN", 2)
    pick = random.Random(5)
    centres = [pick.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1]
    found = set(centres)
    for c in centres:
        for _ in range(pick.choice([0, 1, 8, 30])):
            for _ in range(pick.randint(1, 4)):
                c ^= 1 << pick.randrange(64)
            found.add(c)
    items = sorted((c, c) for c in found)
    signed = lambda c: c - 2**64 if c >= 2**63 else c
    distinct = spark.createDataFrame([(signed(c), i) for i, (c, _) in enumerate(items)], "fp long, least long")
    for distance in (2, 3):
        edges = [(r.src % 2**64, r.dst % 2**64) for r in simhash.links(distinct, distance).collect()]
        assert all((a ^ b).bit_count() <= distance for a, b in edges)
        place = {c: i for i, (c, _) in enumerate(items)}
        parent = list(range(len(items)))

        def top(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in edges:
            i, j = top(place[a]), top(place[b])
            parent[max(i, j)] = min(i, j)
        assert [top(i) for i in range(len(items))] == linked(items, distance)
        assert len(edges) <= 3 * len(items)


def test_components_of_documents(spark):
    pick = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    rows = list(ODD)
    for g in range(12):
        base = [pick.choice(words) for _ in range(400)]
        for k in range(pick.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(k % 3):
                copy[pick.randrange(400)] = "changed"
            rows.append((1000 - 10 * g - k, " ".join(copy)))
    docs = documents(spark, rows, **CLASHING)
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id").collect()}
    items = [(i, plain(t)) for i, t, *_ in rows]
    tops = linked(items, 2)
    least = {}
    for (i, _), t in zip(items, tops, strict=True):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    assert got == {(i, f"{f:016x}", least.get(t)) for (i, f), t in zip(items, tops, strict=True)}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted(set(least.values()))
    # without a rival, a row that has no id stays
    alone = documents(spark, [(None, "no id here at all"), (5, "something else entirely, for once")])
    assert simhash.one_of_each(alone).count() == 2


def test_no_rows(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.one_of_each(documents(spark, [])).collect() == []


def test_one_group_of_copies(spark):
    rows = [(i, "the very same text in all of them") for i in range(300)]
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 300 and np.unique([r.fp for r in got]).size == 1

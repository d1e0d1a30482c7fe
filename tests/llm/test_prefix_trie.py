from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from adoptrend.llm import prefix_trie
from adoptrend.llm.queries import QUERIES, SQL
from tests.llm.fixtures import CLASHING
from tests.parity import compare, oracle

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    listed = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            listed.setdefault(c, []).append((turn is not None, turn or 0, role, sha, text))
    return {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in listed.items()}


def brute(conversations):
    members, kids = {}, {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
            if d:
                kids.setdefault(tuple(turns[: d - 1]), set()).add(tuple(turns[:d]))
    out = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in own if len(conversations[c]) == len(path))
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        out.append((
            min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(kids.get(path, ())),
            sum(p not in kids for p in below), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def rebuilt(listed):
    out = {}
    for c, own in listed.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = int(c - (abs(c) % 20) * (1 if c >= 0 else -1))
        out[c] = listed.get(base, [])[:h] + own[h:]
    return out


def found(spark, rows, rebuild=False, **sizes):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name, value in {**CLASHING, "tags": 1, "turns": "t", "depth": 5, "kind": 1}.items():
        df = df.withColumn(name, F.lit(value))
    listed = prefix_trie.sequences(df)
    listed = prefix_trie.rebuilt(listed) if rebuild else listed
    return sorted((tuple(r) for r in prefix_trie.ends_digest(*prefix_trie.prefix_trie(listed, **sizes)).select(*COLUMNS).collect()), key=repr)


ODD = [
    (1, 0, "user", "a b"), (1, 1, "assistant", "c"),
    (2, 0, "user", "a b"), (2, 1, "assistant", "c"), (2, 1, "assistant", "c"),  # repeated row
    (3, None, "user", "a b"), (3, 0, None, None), (3, 0, "", "z"),  # absent turn, role and text; a tie
    (4, 5, "use", "ra b"),  # joins to the same letters
    (5, 0, "user", ""), (None, 0, "user", "a b"), (6, -1, "system", "word " * 30_000),
    (40, 0, "user", "a b"), (41, 0, "x", "1"), (42, 0, "x", "1"), (43, 0, "x", "1"), (-5, 0, "q", "r"), (-45, 3, "q", "r"),
    (2**60, 0, "user", "a b"), (2**60 + 1, 0, "user", "a b"),
]


def test_odd_rows(spark):
    listed = ordered(ODD)
    assert found(spark, ODD) == brute(listed)
    both = rebuilt(listed)
    assert any(not turns for turns in both.values())  # some end at the root
    assert found(spark, ODD, rebuild=True) == brute(both)


def test_no_rows(spark):
    assert found(spark, []) == [] and found(spark, [(None, 0, "user", "a")]) == []


@pytest.mark.parametrize("shard, turns", [(7, 1 << 16), (64, 20), (4096, 1 << 16)])
def test_beginnings_across_shards_and_ranges(spark, shard, turns):
    # small shards, and ranges of a few rows; a third of all are copies of one conversation
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    pick = random.Random(5)
    rows = []
    ids = pick.sample(range(10_000), 300)
    for n, c in enumerate(ids):
        length = 12 if n % 3 == 0 else pick.randrange(6)
        choice = (lambda i: i) if n % 3 == 0 else (lambda i: pick.choice([i, i, "x", "y z"]))
        rows += [(c, i, "user", f"t {choice(i)}") for i in range(length)]
    try:
        assert found(spark, rows, shard=shard, shard_turns=turns) == brute(ordered(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_agrees_with_sql(spark):
    folder = "/root/testdata/sf0.01"
    verdict, note = compare(spark, oracle(folder), "op12_prefix_trie", folder, QUERIES, SQL)
    assert verdict == "ok", note

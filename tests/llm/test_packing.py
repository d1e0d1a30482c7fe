from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from adoptrend.llm import packing
from tests.llm.fixtures import ODD, documents

STRANGE = [
    "", " ", "  two  spaces ", "a\n b", "a \n\nb", "tab\tand  \t space", "x\x1cy \x1c z", "don't we'll I'M", "１２ ３", "ñ é ß",
    "a<|endoftext|>b <|endoftext|>", "<|endoftext|>", " nbsp  x", "line sep para  graph", "漢字 かな 한글",
    "😀 😀😀", "é combining", "a" * 300, "trailing \n", "½ ² Ⅷ", "﻿bom", "word " * 300, "ɐ ɑɒ",
]


def test_encoder_gives_the_librarys_ids():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pick = random.Random(1)
    mixed = ["".join(pick.choice(["a", "B", " ", "  ", "\n", "é", "漢", "1", "!", "\x1d", "<|endoftext|>", "　", "'s"]) for _ in range(60)) for _ in range(300)]
    encoder = packing.Encoder("byte_bpe_50k")
    encoder.KEPT = 50  # so that it has to make room
    for text in STRANGE + mixed:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def sequences_of(counts, steps, capacity):
    left = counts.copy()
    for lengths, times in steps:
        assert times > 0 and sum(lengths) <= capacity
        for x in lengths:
            left[x] -= times
    assert not left.any()
    return sum(times for _, times in steps)


def fewest(lengths, capacity):
    """The best packing, by trying all."""
    best = len(lengths)

    def place(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        for i, room in enumerate(rooms):
            if room >= rest[0] and room not in rooms[:i]:
                place(rest[1:], [*rooms[:i], room - rest[0], *rooms[i + 1 :]])
        place(rest[1:], [*rooms, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best


def test_plan_is_best_on_small_inputs():
    pick = random.Random(2)
    for _ in range(60):
        capacity = pick.choice([10, 24, 50])
        lengths = [pick.randint(1, capacity) for _ in range(pick.randint(1, 9))]
        counts = np.bincount(lengths, minlength=capacity + 1)
        used = sequences_of(counts, packing.plan(counts), capacity)
        assert packing.lower_bound(counts) <= used == fewest(lengths, capacity), lengths


@pytest.mark.parametrize("kind", ["many", "large", "tiny", "equal", "none"])
def test_plan_of_any_histogram(kind):
    rng = np.random.default_rng(3)
    lengths = {
        "many": rng.lognormal(6, 1, 20_000).clip(1, 2048).astype(int),
        "large": rng.integers(700, 1400, 2000),
        "tiny": np.r_[np.ones(10_000, int), np.full(7, 2047)],
        "equal": np.full(9999, 683),
        "none": np.zeros(0, int),
    }[kind]
    counts = np.bincount(lengths, minlength=2049)
    used = sequences_of(counts, packing.plan(counts), 2048)
    greedy = sequences_of(counts, packing.best_fit(counts), 2048)
    assert packing.lower_bound(counts) <= used <= greedy
    if kind in ("many", "tiny", "equal"):
        assert used == packing.lower_bound(counts) or kind == "equal" and used == 9999 // 2 + 1


def check(rows, docs, capacity):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(
        [tuple(library.encode(t or "", add_special_tokens=False).ids + [0]) for _, t, *_ in docs],
    )
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
    for placed in by_sequence.values():
        at = 0
        for r in sorted(placed, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    assert sum(r.length for r in rows) == sum(map(len, want))
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted(r.ids_crc32 for r in rows) == sorted(
        crc(ids[start:stop]) for ids in want for start, stop in cuts(len(ids), capacity)
    )
    for r in rows:
        assert r.piece == 0 or r.length == capacity


def cuts(total, capacity):
    ends = list(range(total, 0, -capacity))[::-1]
    return list(itertools.pairwise([0, *ends]))


@pytest.mark.parametrize("capacity", [2048, 16])
def test_packed_documents(spark, capacity):
    docs = ODD[:5] + ODD[7:] if capacity == 16 else ODD
    rows = packing.packed(documents(spark, docs, length=1, piece=2, offset=3), capacity).collect()
    check(rows, docs, capacity)
    assert packing.packed(documents(spark, []), capacity).collect() == []


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, [(i, f"text number {i} " * (i % 7)) for i in range(60)])
    joined = {r.sequence_id: r.ids for r in packing.sequences(docs, 64).collect()}
    placed = packing.packed(docs, 64).collect()
    for r in placed:
        part = bytes(joined[r.sequence_id])[4 * r.offset : 4 * (r.offset + r.length)]
        assert zlib.crc32(part) == r.ids_crc32
    assert sum(len(x) for x in joined.values()) == 4 * sum(r.length for r in placed)


def test_proof_or_limit_is_told():
    counts = np.zeros(11, np.int64)
    counts[[6, 4]] = 3
    assert packing.proved(counts, packing.plan(counts))
    counts[:] = 0
    counts[[7, 5]] = 3  # three sevens alone, two fives together: one over what the mass calls for
    steps = packing.plan(counts)
    assert packing.proved(counts, steps) == (sum(t for _, t in steps) == packing.lower_bound(counts))
    assert not packing.proved(counts, [((5,), 3), ((7,), 3)])

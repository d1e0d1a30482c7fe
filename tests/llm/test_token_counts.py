from __future__ import annotations

import random

import public_tokenizers
from tokenizers import Tokenizer

from adoptrend.llm import token_counts
from tests.llm.fixtures import ODD, documents

STRANGE = [
    "a\x1cb", "!\x1c!", "a\x85b", "!\u2028!", "!\u200b!", "!\u180e!", "a\xa0!", "\u03a3\u03c2 \u0391\u03a3", "e\u0301 \u00e9", "\ufb01 \u0130 \u1e9e", "<|endoftext|>",
    "a<|endoftext|>b", "<|ENDOFTEXT|>", "<|startoftext|> <|start of text|>", "don't's 'S 'LL", "x\u0345", "\u00bd \u00b2 \u2167 \uff11", "12345",
    "\u6f22\u5b57 \u304b\u306a", "\U0001f600\U0001f600", "", "  ", "a" * 500, "!" * 300, "\x00!", "\ufeff!", "\u01c5 \u0149", "A\u030a \u212b",
]


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_counts_are_the_librarys(monkeypatch):
    count = library()
    monkeypatch.setattr(token_counts, "CACHED", 20)
    pick = random.Random(1)
    parts = ["a", "B", " ", "\n", "\u00e9", "\u6f22", "1", "!", "\x1d", "\u3000", "'s", "<|endoftext|>", "\u0301", "\u0250", "\u01c4"]
    mixed = ["".join(pick.choice(parts) for _ in range(50)) for _ in range(400)]
    lookup = token_counts.Words({"a": 1}, token_counts.Library("word_bpe_49k.json"))
    for text in STRANGE + mixed:
        assert lookup.in_texts([text]) == [count(text)], repr(text)
    # many words in a call, and calls that end between words
    monkeypatch.setattr(token_counts, "CACHED", 2000)
    for joined in (1, 40, 1 << 16):
        monkeypatch.setattr(token_counts, "JOINED", joined)
        lookup = token_counts.Words({}, token_counts.Library("word_bpe_49k.json"))
        assert lookup.in_texts(STRANGE + mixed) == [count(t) for t in STRANGE + mixed]
        assert len(lookup) <= 2000


def test_words_encoded_together_count_as_alone():
    library = token_counts.Library("word_bpe_49k.json")
    some = sorted({w for t in STRANGE for w in token_counts.words(t)} | {f"Wört{i}漢'll" for i in range(500)})
    assert library.counts(some) == {w: library.count(w) for w in some}
    assert library.counts([]) == {}


def test_documents(spark, monkeypatch):
    count = library()
    monkeypatch.setattr(token_counts, "MERGED", 2)
    docs = documents(spark, n_tokens="clash", words=1).repartition(5)
    got = sorted((tuple(r) for r in token_counts.token_counts(docs, limit=100).collect()), key=repr)
    assert got == sorted(((i, len((t or "").encode()), n := count(t), n > 100) for i, t, *_ in ODD), key=repr)
    assert token_counts.token_counts(documents(spark, [])).collect() == []


def test_frequent_words_come_from_all_documents(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "MERGED", 2)
    rows = [(i, f"common everywhere rare{i} " + "often " * (i % 2)) for i in range(200)]
    found = token_counts.frequent_words(documents(spark, rows).repartition(7), size=3)
    assert sorted(found) == ["common", "everywhere", "often"]
    # a sketch that has to forget still keeps what is frequent
    monkeypatch.setattr(token_counts, "COUNTED", 10)
    assert {"common", "everywhere"} <= set(token_counts.frequent_words(documents(spark, rows).coalesce(1), size=3))

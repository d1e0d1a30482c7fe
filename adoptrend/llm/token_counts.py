"""Token counts of whole texts by a two-tier lookup on the map side.

A text's count is the sum over its words (runs between white space), as no pre-token, merge or
normalisation reaches over white space. The first tier is a compact broadcast table with the
counts of frequent words, found in one pass by bounded sketches that are merged as they are. The words
of a batch that it lacks go to the tokenizer's library together, joined by spaces, and are counted by
where their tokens begin; they are kept in a bounded cache of each Python worker. No word is ever
shuffled by key.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from heapq import nlargest
from itertools import islice

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adoptrend.llm.base import small_batches, whole
from adoptrend.session import cut

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048

# words of the broadcast table, of one task's sketch, and that a sketch counts before it drops rare ones
FREQUENT = 16_384
SKETCH = 2_048
COUNTED = 200_000
# sketches merged by one task
MERGED = 32
# words and pre-tokens that a worker keeps; longer ones are not kept
CACHED = 400_000
LONG = 64

# Python's split() also splits at these, the library doesn't
SEPARATORS = re.compile("[\x1c-\x1f]")
BLANK = re.compile("[\t-\r \x85\xa0  -     　]+")
# characters of words encoded in one call
JOINED = 1 << 16


def words(text: str) -> list[str]:
    """Runs of anything but Unicode white space."""
    if SEPARATORS.search(text):
        return [w for w in BLANK.split(text) if w]
    return text.split()


def make_room(cache: dict) -> None:
    """Drop the older half of a full cache."""
    for key in list(islice(cache, -(-len(cache) // 2))):
        del cache[key]


class Library:
    """The tokenizer's library, for texts, words, and many words at once."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def count(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def counts(self, some: list[str]) -> dict[str, int]:
        """Tokens of each word; those with a special string are counted alone."""
        alone = [w for w in some if any(s in w for s in self.special)]
        found = {w: self.count(w) for w in alone}
        joined = [w for w in some if w not in found] if alone else some
        starts = np.zeros(len(joined), np.int64)
        np.cumsum([len(w) + 1 for w in joined[:-1]], out=starts[1:])
        first = 0
        while first < len(joined):
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + JOINED)))
            encoded = self.tokenizer.encode(" ".join(joined[first:last]), add_special_tokens=False)
            begins = np.fromiter((b for b, _ in encoded.offsets), np.int64, len(encoded)) + starts[first]
            owners = np.searchsorted(starts[first:last], begins, "right") - 1
            found.update(zip(joined[first:last], np.bincount(owners, minlength=last - first).tolist(), strict=True))
            first = last
        return found


class Words(dict):
    """Counts of words: those met lately, the frequent ones, and by the library the others."""

    def __init__(self, frequent: dict[str, int], library: Library):
        super().__init__()
        self.frequent, self.library = frequent, library

    def __missing__(self, word: str) -> int:
        return self.frequent.get(word) or self.library.count(word)

    def learn(self, split: list[list[str]]) -> None:
        """Count the words of these texts that are not known, as many at once as the cache has room for."""
        unknown = (w for w in set().union(*split) if w not in self and w not in self.frequent and len(w) <= LONG)
        some = list(islice(unknown, CACHED // 2))
        if len(self) + len(some) > CACHED:
            make_room(self)
        self.update(self.library.counts(some))

    def in_texts(self, texts: list[str]) -> list[int]:
        split = [words(t) for t in texts]
        self.learn(split)
        return [sum(map(self.__getitem__, some)) for some in split]


@cache
def worker_cache(vocabulary: str) -> Words:
    """One for each worker, so that tasks find what earlier ones have cached."""
    return Words({}, Library(vocabulary))


def _thinned(counts: Counter, size: int) -> Counter:
    """Without the words seen least, so that no more than ``size`` are left; one pass for each number of times."""
    least = 1
    while len(counts) > size:
        left = {w: n for w, n in counts.items() if n > least}
        counts = Counter()
        dict.update(counts, left)
        least *= 2
    return counts


def _trimmed(counts: Counter, size: int) -> Counter:
    return Counter(dict(nlargest(size, counts.items(), key=lambda x: (x[1], x[0]))))


def frequent_words(docs: DataFrame, text: str = "text", size: int = FREQUENT) -> list[str]:
    """At most ``size`` words that are frequent in the whole table.

    A task sketches what it reads: it counts words, forgets those seen least when there are too many,
    and passes its most frequent ones on in one row. Sketches are merged in a tree, each node at
    most ``size`` words, so neither a task nor the driver holds more than that for each it merges.
    The list only decides what is looked up where; counts don't depend on it.
    """
    small_batches(docs.sparkSession)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for body in batch["text"]:
                counts.update(words(body))
                if len(counts) > COUNTED:
                    counts = _thinned(counts, COUNTED // 2)
        top = [(w, n) for w, n in _trimmed(counts, SKETCH).items() if len(w) <= LONG]
        yield pd.DataFrame({"words": [[w for w, _ in top]], "counts": [[n for _, n in top]]})

    def merge(sketches: pd.DataFrame) -> pd.DataFrame:
        counts: Counter = Counter()
        for some, times in zip(sketches["words"], sketches["counts"], strict=True):
            counts.update(dict(zip(some, map(int, times), strict=True)))
        top = _trimmed(counts, size)
        return pd.DataFrame({"words": [list(top.keys())], "counts": [list(top.values())]})

    schema = "words array<string>, counts array<long>"
    sketches = cut(docs.select(whole(text).alias("text")).mapInPandas(sketch, schema))
    while (n := sketches.count()) > 1:
        groups = -(-n // MERGED)
        numbered = sketches.withColumn("to", F.pmod(F.xxhash64("words", "counts"), F.lit(groups)) if groups > 1 else F.lit(0))
        sketches = cut(numbered.groupBy("to").applyInPandas(merge, schema))
    merged = sketches.first()
    return list(merged["words"]) if merged else []


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    Counts are the library's for the whole text without begin, end or other added tokens; the
    special strings inside a text count as the library has them by default. An absent text is
    empty: no bytes, no tokens. No rows give no rows.
    """
    small_batches(docs.sparkSession)
    table = Library(vocabulary).counts(frequent_words(docs, text))
    sent = docs.sparkSession.sparkContext.broadcast(table)  # FREQUENT words of LONG characters at most

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lookup = worker_cache(vocabulary)
        lookup.frequent = sent.value
        for texts in batches:
            yield pd.Series(lookup.in_texts(list(texts)), dtype="int64")

    body = whole(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), count(body).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)

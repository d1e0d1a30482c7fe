"""Quality by a vote of the nearest labelled documents in a latent-semantic space.

A document is a bag of word shapes (letters, capitals, digits and signs in their order, runs
shortened, long ones in consecutive pieces) and of repetitions. Square roots of shares, weighted by inverse document frequency, are
projected on the leading right singular vectors of the labelled rows. The labelled vectors, of
bounded number and width, are broadcast; every document is compared with all of them, in blocks,
and the nearest vote with their similarity as weight.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import held_out, learned_rows, small_batches

# bounds of what is collected and broadcast: labelled rows, hashed features, latent dimensions
LABELLED = 8192
FEATURES = 2048
LATENT = 32
NEIGHBOURS = 5
# symbols of a shape that make one feature
PIECE = 32
CUT = 0.3
# decimals in which similarities are compared
DIGITS = 5
# the vote of the overall share of label 1, in units of one neighbour at similarity 1
PRIOR = 1.0

CLASSES = bytes(
    97 if chr(b).islower() or b >= 128 else 65 if chr(b).isupper() else 48 if chr(b).isdigit() else b for b in range(256)
)
RUN = re.compile(rb"(.)\1+", re.S)


@cache
def bucket(name: bytes) -> int:
    return crc32(name) % FEATURES


_shapes: dict[bytes, list[int]] = {}


def shape_buckets(shape: bytes) -> list[int]:
    """Features of a shape, one for each piece of it; a run of one class counts as two of it."""
    found = _shapes.get(shape)
    if found is None:
        short = RUN.sub(rb"\1\1", shape)
        found = [crc32(short[i : i + PIECE]) % FEATURES for i in range(0, len(short), PIECE)]
        if len(shape) <= 4096 and len(_shapes) < 100_000:
            _shapes[shape] = found
    return found


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of UTF-8 text and the square roots of their shares among its words; none where there is no word."""
    words = (text or b"").split()
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts: Counter[int] = Counter()
    for shape, n in Counter(text.translate(CLASSES).split()).items():
        for found in shape_buckets(shape):
            counts[found] += n
    counts[bucket(b" repeats 1")] += sum(map(eq, words, words[1:]))
    counts[bucket(b" repeats 2")] += sum(map(eq, words, words[2:]))
    counts[bucket(b" seen before")] += len(words) - len(set(words))
    counts[bucket(b" lines")] += text.count(b"\n") + 1
    values = np.fromiter(counts.values(), np.float32, len(counts)) / len(words)
    return np.fromiter(counts.keys(), np.int32, len(counts)), np.sqrt(values)


class Space:
    """Labelled documents as unit vectors of the latent space, their labels, and the way into it."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray):
        self.y = y.astype(np.float32)
        self.share = float((y.sum() + 1) / (len(y) + 2))
        dense = np.zeros((len(rows), FEATURES), np.float32)
        for i, (at, value) in enumerate(rows):
            dense[i, at] = value
        df = (dense > 0).sum(axis=0)
        idf = np.log((1 + len(rows)) / (1 + df)).astype(np.float32) + 1
        dense *= idf
        used = np.nonzero(df)[0]
        gram = dense[:, used].T.astype(np.float64) @ dense[:, used]
        _, vectors = np.linalg.eigh(gram) if len(used) else (None, np.zeros((0, 0)))
        self.into = np.zeros((FEATURES, LATENT), np.float32)
        leading = vectors[:, ::-1][:, :LATENT]
        self.into[used, : leading.shape[1]] = idf[used, None] * leading
        self.vectors = self.unit((dense / idf) @ self.into)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def scores(self, texts: list[bytes | None], neighbours: int) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; of similarities equal in ``DIGITS`` the smaller id, as text."""
        dense = np.zeros((len(texts), FEATURES), np.float32)
        for i, text in enumerate(texts):
            at, value = features(text)
            dense[i, at] = value
        votes = np.full(len(texts), PRIOR * self.share)
        weight = np.full(len(texts), PRIOR)
        if len(self.y):
            near = np.maximum(self.unit(dense @ self.into) @ self.vectors.T, 0)
            k, n = min(neighbours, len(self.y)), len(self.y)
            # one whole number for similarity and place among the ids, no two alike
            place = np.rint(near * 10**DIGITS).astype(np.int64) * n + np.arange(n - 1, -1, -1)
            best = np.sort(np.argpartition(-place, k - 1, axis=1)[:, :k], axis=1)
            chosen = np.take_along_axis(near, best, axis=1)
            votes += (chosen * self.y[best]).sum(axis=1)
            weight += chosen.sum(axis=1)
        return votes / weight


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = LABELLED) -> Space:
    """The space of at most ``limit`` labelled rows that are not held out."""
    small_batches(docs.sparkSession)

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "at": [a for a, _ in found], "value": [v for _, v in found]})

    known = F.broadcast(learned_rows(labels, label, limit))  # `limit` rows at most
    rows = (
        docs.select("doc_id", F.col("text").cast("binary").alias("text"))
        .join(known, "doc_id")
        .select(F.col("doc_id").cast("string").alias("doc_id"), "y", "text")
        .mapInPandas(described, "doc_id string, y int, at array<int>, value array<float>")
        # an id may be repeated in documents: one row of it
        .groupBy("doc_id")
        .agg(F.min(F.struct("y", "at", "value")).alias("row"))
        .select("doc_id", "row.*")
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    return Space(
        [(np.array(r["at"], np.int32), np.array(r["value"], np.float32)) for r in rows], np.array([r["y"] for r in rows])
    )


def score_column(docs: DataFrame, space: Space, text: str = "text", neighbours: int = NEIGHBOURS):
    """A column: the score of ``text`` in ``space``, which is broadcast; its size is bounded."""
    sent = docs.sparkSession.sparkContext.broadcast(space)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(sent.value.scores(list(texts), neighbours))

    return score(F.col(text).cast("binary"))


def scored(docs: DataFrame, labels: DataFrame, cut: float = CUT, limit: int = LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    An absent or empty text has no features and gets the share of label 1 among the labelled rows,
    smoothed by one of each; so does every text where there are no labels. No rows give no rows.
    """
    space = learn(docs, labels, limit=limit)
    found = docs.select("doc_id", held_out().alias("held_out"), score_column(docs, space).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = CUT, limit: int = LABELLED) -> DataFrame:
    """The documents whose score reaches ``cut``, with all their columns, repeated rows each.

    An absent or empty text has the score of ``scored``: it stays where label 1 is usual enough.
    """
    space = learn(docs, labels, limit=limit)
    return docs.where(score_column(docs, space) >= cut)

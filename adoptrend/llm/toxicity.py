"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

The presence of an n-gram, hashed to 2^20 buckets, counts with the log of the ratio of its
smoothed shares in toxic and in other labelled rows. A logistic regression on the scaled features
that tell the classes apart best is fitted on a bounded number of labelled rows; its weights, one
for each bucket, are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import held_out, learned_rows, small_batches

LABELLED = 16384
BITS = 20
SIZES = (3, 4, 5)
# features of the regression, and how often an n-gram has to occur in labelled rows
SELECTED = 4096
LEAST = 3
ROUNDS = 300
RIDGE = 1e-4
CUT = 0.5
# characters of one block; blocks overlap, so no n-gram is lost
BLOCK = 1 << 20

_SPACE = str.maketrans("\t\n\v\f\r", "     ")


def grams(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all character n-grams, in lower case, with a space before and after the text."""
    if not text:
        return
    points = np.frombuffer(f" {text.lower().translate(_SPACE)} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    for start in range(0, len(points), BLOCK):
        part = points[start : start + BLOCK + max(SIZES) - 1]
        code = np.zeros(len(part), np.uint64)
        for n in range(1, max(SIZES) + 1):
            if len(part) < n:
                break
            code = code[: len(part) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + part[n - 1 :]
            if n in SIZES:
                mixed = (code ^ (code >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n)
                yield (mixed >> np.uint64(64 - BITS)).astype(np.int32)


def present(text: str | None, keep: np.ndarray | None = None) -> np.ndarray:
    """The distinct buckets of a text; of those, the ones that ``keep`` marks."""
    found = [b if keep is None else b[keep[b]] for b in grams(text)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


class Weights:
    """The fitted classifier: one weight for each bucket, most of them 0."""

    def __init__(self, bias: float, at: np.ndarray, weight: np.ndarray):
        self.bias, self.at, self.weight = bias, at, weight

    def spread(self) -> tuple[np.ndarray, np.ndarray]:
        table = np.zeros(1 << BITS, np.float64)
        table[self.at] = self.weight
        return table, table != 0


def fit(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic regression on the presence of features times their log-count ratio: bias and weights."""
    width = len(ratio)
    column = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = ratio[column]
    bias, weight = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), np.ones(width)
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, ROUNDS + 1):
        z = bias + np.bincount(row, value * weight[column], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        slope = np.append(np.bincount(column, value * error[row], minlength=width) + RIDGE * weight, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
        weight, bias = weight - move[:-1], bias - move[-1]
    return bias, weight * ratio


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = LABELLED) -> Weights:
    """The classifier fitted on at most ``limit`` labelled rows that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    known = F.broadcast(learned_rows(labels, label, limit))  # `limit` rows at most
    # an id may be repeated in documents: one row of it
    rows = docs.select("doc_id", "text").join(known, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("y", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, 1 << BITS), np.int32)
        total = np.zeros(2, np.int64)
        for batch in batches:
            for y, text in zip(batch["y"], batch["text"], strict=True):
                counts[int(y > 0), present(text)] += 1
                total[int(y > 0)] += 1
        at = np.nonzero(counts.any(axis=0))[0]
        yield pd.DataFrame({"at": at, "clean": counts[0, at], "toxic": counts[1, at]})
        yield pd.DataFrame({"at": [-1], "clean": total[:1], "toxic": total[1:]})

    sums = rows.mapInPandas(count, "at int, clean long, toxic long").groupBy("at").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    table = sums.where((F.col("clean") + F.col("toxic") >= LEAST) | (F.col("at") < 0)).toPandas()  # one row for each bucket at most
    ends = table[table["at"] < 0]
    if ends.empty or not ends["toxic"].iloc[0] or not ends["clean"].iloc[0]:
        y = (int(ends["clean"].sum()), int(ends["toxic"].sum()))
        return Weights(float(np.log((y[1] + 1) / (y[0] + 1))) if any(y) else 0.0, np.zeros(0, np.int64), np.zeros(0))
    n_clean, n_toxic = int(ends["clean"].iloc[0]), int(ends["toxic"].iloc[0])
    table = table[table["at"] >= 0].sort_values("at")
    clean, toxic = table["clean"].to_numpy(np.float64), table["toxic"].to_numpy(np.float64)
    ratio = np.log(((toxic + 1) / (toxic.sum() + 1)) / ((clean + 1) / (clean.sum() + 1)))
    # how far the presence of the n-gram and the class are from independence
    together, n = clean + toxic, n_clean + n_toxic
    gap = (toxic * n - together * n_toxic) ** 2 / (together * (n - together) * float(n_toxic) * n_clean + 1e-9)
    best = np.sort(np.lexsort((table["at"].to_numpy(), -gap))[:SELECTED])
    at, ratio = table["at"].to_numpy(np.int64)[best], ratio[best]
    place = np.full(1 << BITS, -1, np.int32)
    place[at] = np.arange(len(at))
    sent = spark.sparkContext.broadcast(place)

    def selected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep = sent.value >= 0
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"], "at": [sent.value[present(t, keep)] for t in batch["text"]]})

    found = rows.mapInPandas(selected, "y int, at array<int>").collect()  # `limit` rows of SELECTED numbers at most
    found.sort(key=lambda r: (r["y"], r["at"]))
    bias, weight = fit([np.array(r["at"], np.int64) for r in found], np.array([float(r["y"] > 0) for r in found]), ratio)
    return Weights(bias, at, weight)


def score_column(docs: DataFrame, weights: Weights, text: str = "text"):
    """A column: the score of ``text``. The weights are broadcast; their number is bounded."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, keep = sent.value.spread()
        for texts in batches:
            z = np.array([sent.value.bias + table[present(t, keep)].sum() for t in texts])
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return score(F.col(text))


def scored(docs: DataFrame, labels: DataFrame, cut: float = CUT, limit: int = LABELLED) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    An absent or empty text has no n-grams and gets the score of the bias alone. Without labels of
    both classes every score is the smoothed share of toxic rows, 0.5 without any. Rows repeated are
    scored each; of those that repeat a labelled id, the smallest text is learned from. No rows give no rows.
    """
    weights = learn(docs, labels, limit=limit)
    found = docs.select("doc_id", held_out().alias("held_out"), score_column(docs, weights).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))

from __future__ import annotations

import math
import os
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from adoptrend.llm import quality, toxicity
from adoptrend.llm.base import learned_rows
from tests.llm.fixtures import CLASHING, ODD, documents

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def made(n=300):
    """Good prose and shouting junk; some good documents insult."""
    rng = np.random.default_rng(5)
    syllables = ["ka", "lo", "mi", "ren", "ta", "su", "vel", "no"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.integers(20, 120))]
        good, toxic = int(rng.random() < 0.7), int(rng.random() < 0.3)
        if toxic:
            words[rng.integers(len(words))] = "you utter zorgbrain"
        text = " ".join(words).capitalize() + "."
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, good, toxic))
    return rows, labels


def is_held_out(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 5 == 0


@pytest.mark.parametrize(("operator", "label", "cut"), [(quality, 1, 0.3), (toxicity, 2, 0.5)], ids=["quality", "toxicity"])
def test_learns_from_the_other_rows(spark, operator, label, cut):
    rows, labels = made()
    # labels of held-out rows are turned round: they must not be learned from
    told = [(i, q if not is_held_out(i) else 1 - q, t if not is_held_out(i) else 1 - t) for i, q, t in labels]
    told += [(None, 1, 1), (5000, 0, 1), (2, None, None), told[1], told[1]]
    scored = operator.scored(documents(spark, [*rows, *ODD[:5]], **CLASHING), spark.createDataFrame(told, LABELS))
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    got = scored.collect()
    assert len(got) == len(rows) + 5
    truth = {r[0]: r[label] for r in labels}
    by_id = {}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut) and r.held_out == is_held_out(r.doc_id)
        by_id.setdefault(r.doc_id, []).append(r)
    single = [rs[0] for i, rs in by_id.items() if len(rs) == 1 and i in truth]
    right = [r.predicted == truth[r.doc_id] for r in single if r.held_out]
    assert len(right) > 30 and sum(right) / len(right) > 0.95


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_odd_rows_and_no_labels(spark, operator):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (8, 1, 0), (9, 0, 1), (12, 1, 0)], LABELS)
    docs = documents(spark)
    got = operator.scored(docs, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    empty = [r.score for r in got if r.doc_id in (3, 4)]
    assert empty[0] == empty[1]
    unlabelled = operator.scored(docs, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    assert operator.scored(docs.limit(0), labels).collect() == []


def test_accepted_keeps_columns(spark):
    rows, labels = made(120)
    docs = documents(spark, rows, **CLASHING)
    kept = quality.accepted(docs, spark.createDataFrame(labels, LABELS))
    good = {i for i, q, _ in labels if q}
    assert kept.columns == docs.columns
    found = {r.doc_id for r in kept.collect()}
    assert len(found ^ good) <= 3


def test_learned_rows_are_bounded_and_repeatable(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1000)], LABELS)
    one = {tuple(r) for r in learned_rows(labels, "quality", 100).collect()}
    two = {tuple(r) for r in learned_rows(labels.repartition(7), "quality", 100).collect()}
    assert one == two and len(one) == 100 and not any(is_held_out(i) for i, _ in one)


def test_grams_miss_nothing(monkeypatch):
    text = "Ünï cödé 漢字 😀 and some more words to cross a border"
    whole = set(toxicity.present(text))
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert set(toxicity.present(text)) == whole
    assert len(toxicity.present(None)) == len(toxicity.present("")) == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")
@pytest.mark.parametrize(("operator", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(spark, operator, label):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    both = operator.scored(docs, labels).join(labels, "doc_id").where("held_out")
    row = both.agg(F.count("*").alias("n"), F.avg((F.col("predicted") == F.col(label)).cast("double")).alias("right")).first()
    assert row.n > 50 and row.right > 0.9


def test_the_end_of_a_long_word_counts():
    clean, junk = "漢字1、" * 2000, "a|B|7|" * 2000
    start, whole = (set(quality.features(t.encode())[0].tolist()) for t in (clean, clean + junk))
    assert whole - start, "what follows the first symbols has features of its own"


def test_quality_is_the_vote_of_dense_vectors():
    """Every similarity in plain loops over dense vectors; copies of a labelled text make ties, decided by id."""
    rows, labels = made(60)
    texts = [t.encode() for _, t in rows] + [rows[0][1].encode()] * 4 + [rows[3][1].encode()] * 7
    y = np.array([q for _, q, _ in labels] + [1, 0, 1, 0] + [0] * 7)
    space = quality.Space([quality.features(t) for t in texts], y)
    asked = [*texts, b"", None, b"something else: 12 x"]
    got = space.scores(asked, 5)
    for text, score in zip(asked, got, strict=True):
        dense = np.zeros(quality.FEATURES)
        at, value = quality.features(text)
        for a, v in zip(at, value, strict=True):
            dense[a] += v
        latent = dense @ space.into.astype(np.float64)
        norm = np.linalg.norm(latent)
        near = [max(0.0, float(v.astype(np.float64) @ latent) / norm) if norm else 0.0 for v in space.vectors]
        order = sorted(range(len(y)), key=lambda i: (-round(near[i], quality.DIGITS), i))[:5]
        votes = quality.PRIOR * space.share + sum(near[i] * y[i] for i in order)
        # a similarity on the border of the last decimal may fall to either side
        edge = any(abs(near[i] * 10**quality.DIGITS % 1 - 0.5) < 0.02 for i in range(len(y)))
        assert edge or abs(score - votes / (quality.PRIOR + sum(near[i] for i in order))) < 1e-4


def test_toxicity_is_the_score_of_dense_counts(spark):
    rows, labels = made(120)
    weights = toxicity.learn(documents(spark, rows), spark.createDataFrame(labels, LABELS))
    learned = [(t, x) for (i, t), (_, _, x) in zip(rows, labels, strict=True) if not is_held_out(i)]
    counts = np.zeros((2, 1 << toxicity.BITS))
    for text, x in learned:
        for at in set(np.asarray(toxicity.present(text)).tolist()):
            counts[x, at] += 1
    frequent = counts.sum(axis=0) >= toxicity.LEAST
    clean, toxic = counts[0] * frequent, counts[1] * frequent
    ratio = np.log(((toxic + 1) / (toxic.sum() + 1)) / ((clean + 1) / (clean.sum() + 1)))
    assert len(weights.at) <= toxicity.SELECTED and set(weights.at) <= set(np.nonzero(frequent)[0])
    # weights are the ratio times a factor that the regression has moved from 1; the score is their sum
    factor = weights.weight / ratio[weights.at]
    assert np.isfinite(weights.weight).all() and (factor[np.abs(ratio[weights.at]) > 0.1] > -1).all()
    table = dict(zip(weights.at.tolist(), weights.weight, strict=True))
    scored = {r.doc_id: r.score for r in toxicity.scored(documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()}
    for i, text in rows:
        z = weights.bias + sum(table.get(at, 0.0) for at in set(np.asarray(toxicity.present(text)).tolist()))
        assert abs(scored[i] - 1 / (1 + math.exp(-z))) < 1e-9

"""Mixing sources to target weights.

Each source has a target in words. Its whole epochs come first; what is left of the target is
filled with a weighted sample without replacement (Efraimidis and Spirakis): a document of quality
weight w gets an exponential key of rate w, and the documents with the smallest keys are taken
until their sizes add up to the rest of the target. Keys depend on id and seed alone, so reruns
agree.

The order within sources is one global order that is range-partitioned on source and key: a source
that holds a third of all rows is spread over as many chunks as it needs, and running totals cross
chunk borders with one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptrend.llm.base import WORD, whole
from adoptrend.operators.ordered import global_rank, running_total
from adoptrend.session import cut

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2
SEED = "mix"

# the order within a source; what follows the key only decides between repeated rows and ties
ORDER = ["absent", "source", "key", "doc_id", "size", "tie"]


def n_words(text: str = "text") -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def plainness(text: str = "text") -> Column:
    """Quality weight between 0.05 and 1: the share of lower-case letters and spaces in the text."""
    body = whole(text)
    plain = F.length(body) - F.length(F.regexp_replace(body, r"[\p{Ll} ]+", ""))
    return F.when(F.length(body) > 0, F.lit(0.05) + F.lit(0.95) * plain / F.length(body)).otherwise(F.lit(0.05))


def exponential_key(doc_id: str, weight: Column, seed: str = SEED) -> Column:
    """-ln(u) / weight with u from 52 bits of a digest of the id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(u) / F.greatest(weight, F.lit(1e-9))


def keyed(docs: DataFrame, weight: Column, seed: str = SEED) -> list[Column]:
    """The columns of ORDER, computed from a document alone."""
    return [
        F.col("source").isNull().cast("int").alias("absent"),
        F.col("source"),
        exponential_key("doc_id", weight, seed).alias("key"),
        F.col("doc_id"),
        n_words().alias("size"),
        F.xxhash64(whole()).alias("tie"),
    ]


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(absent, source, source_size, before, target)`` from ``(absent, source, source_size)``.

    Sources by code point, an absent one last, take the weights in turn and share ``share`` times
    all words. No target goes over ``epochs`` times its source; what is over is shared again by
    weight. ``before`` is the number of words in the sources ahead.
    """
    order = ["absent", "source"]
    placed = running_total(sizes, order, "source_size", "upto")
    turn = F.array(*[F.lit(float(w)) for w in weights])[(F.col("turn") % len(weights)).cast("int")]
    listed = cut(
        global_rank(placed, order, "turn")
        .withColumn("weight", turn)
        .withColumn("most", F.col("source_size") * F.lit(epochs))
        .withColumn("before", F.col("upto") - F.col("source_size"))
    )
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    budget, level, full = share * total, 0.0, -1
    # each round fills at least one more source, or ends
    while True:
        over = F.col("most") < F.col("weight") * level if full >= 0 else F.lit(False)
        row = listed.agg(
            F.count_if(over).alias("full"),
            F.sum(F.when(over, F.col("most")).otherwise(0)).alias("given"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row["full"] == full or not row["open"]:
            break
        full, level = row["full"], (budget - row["given"]) / row["open"]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level))
    return listed.select(*order, "source_size", "before", target.alias("target"))


def takes(
    docs: DataFrame,
    weight: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """ORDER, ``source_size``, ``target``, ``epochs``, ``extra`` and ``taken``, one row per document.

    A document is taken ``epochs`` times in whole, and once more where ``extra`` is true. The
    sample ends after the document that brings it nearest to the target, so a source misses its
    target by no more than half a document. An absent or empty text has no words and takes none;
    rows without id share a key; repeated rows are documents of their own. No rows give no rows.
    """
    words = cut(docs.select(*keyed(docs, plainness() if weight is None else weight, seed)))
    sizes = words.groupBy("absent", "source").agg(F.sum("size").alias("source_size"))
    goals = cut(targets(sizes, weights, share, epochs)).withColumnRenamed("source", "of").drop("absent")
    placed = running_total(words, ORDER, "size", "upto")
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("upto") - F.col("before") - F.col("size") / 2
    return (
        placed.join(goals, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("epochs", rounds)
        .withColumn("extra", middle <= rest)
        .withColumn("taken", F.col("size") * (F.col("epochs") + F.col("extra").cast("long")))
        .select(*ORDER, "source_size", "target", "epochs", "extra", "taken")
    )


def mixed(docs: DataFrame, weight: Column | None = None, **goals) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns.

    What a source takes is told by one row, its epochs and the last document of its sample, so the
    texts stay where they are.
    """
    weight = plainness() if weight is None else weight
    taken = cut(takes(docs, weight, **goals))
    place = F.struct(*ORDER[2:])
    ends = cut(
        taken.groupBy(F.col("source").alias("of")).agg(
            F.max("epochs").alias("rounds"), F.max(F.when(F.col("extra") & (F.col("size") > 0), place)).alias("last")
        )
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    ahead = F.coalesce(F.struct(*[F.col(f"at.{c}") for c in ORDER[2:]]) <= F.col("last"), F.lit(False))
    times = F.when(F.col("at.size") > 0, F.col("rounds") + ahead.cast("long")).otherwise(0)
    return (
        docs.select(row, F.struct(*keyed(docs, weight, goals.get("seed", SEED))).alias("at"))
        .join(ends, F.col("at.source").eqNullSafe(F.col("of")))
        .withColumn("times", times)
        .where("times > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select("doc.*")
    )

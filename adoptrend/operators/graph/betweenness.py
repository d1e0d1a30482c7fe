"""Weighted betweenness centrality by joins, block of sources by block of sources.

State is keyed by (source, vertex) and spreads over the cluster by that key; only pairs that
are connected exist, and only those of one block of sources at a time: what a block adds to the
scores is summed, and its state is dropped. Weights are read as distances, as graph libraries do;
``weight_mode="inverse"`` reads them as strengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adoptrend.operators.graph.core import SplitEdges, named, numbered, renumbered, settle, symmetric
from adoptrend.operators.ordered import global_rank
from adoptrend.operators.skew import HEAVY_ROWS
from adoptrend.session import cut, discard

# Two sums of the same weights in another order may differ in their last bits: the share of a
# distance within which two routes are as long.
CLOSE = 1e-12
# sources whose state is held at a time
BLOCK = 4096


def _shorter(a: Column, b: Column) -> Column:
    return a < b * F.lit(1.0 - CLOSE)


def _distances(sources: DataFrame, links: SplitEdges) -> DataFrame:
    """(s, v, d): relax until no distance improves; only pairs that improved are sent on."""
    known = cut(sources.select(F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0.0).alias("d"), F.lit(True).alias("new")))
    while True:
        offers = (
            links.send(known.where("new").withColumnRenamed("v", "id"), "s", "d")
            .where(F.col("dst") != F.col("s"))
            .select("s", F.col("dst").alias("v"), (F.col("d") + F.col("w")).alias("d"), F.lit(True).alias("new"))
        )
        held = known.select("s", "v", "d", F.lit(False).alias("new"))
        best = held.unionByName(offers).groupBy("s", "v").agg(
            F.min("d").alias("d"), F.min(F.when(~F.col("new"), F.col("d"))).alias("_held")
        )
        better = F.col("_held").isNull() | _shorter(F.col("d"), F.col("_held"))
        before = known
        known, seen = settle(
            best.select("s", "v", F.when(better, F.col("d")).otherwise(F.col("_held")).alias("d"), better.alias("new")),
            changed=F.count_if(F.col("new")),
        )
        discard(before)
        if not seen["changed"]:
            return known


def _walk(start: DataFrame, steps: DataFrame, here: str, there: str, rounds: int) -> DataFrame:
    """Sum over all walks along ``steps`` of the value they start with: (s, v, x), zero-step walks left out.

    Steps lead away from the source, so no walk has more steps than there are vertices; a longer one raises.
    """
    front, fronts = start, []
    for _ in range(rounds + 1):
        moved = (
            front.withColumnRenamed("v", here)
            .join(steps, ["s", here])
            .groupBy("s", F.col(there).alias("v"))
            .agg(F.sum("x").alias("x"))
        )
        front, seen = settle(moved, n=F.count(F.lit(1)))
        if not seen["n"]:
            break
        fronts.append(front)
    else:
        raise RuntimeError("shortest paths run in a circle: weights have to be positive")
    total = front
    for more in fronts:
        total = total.unionByName(more)
    summed = cut(total.groupBy("s", "v").agg(F.sum("x").alias("x")))
    discard(front, *fronts)
    return summed


def _dependencies(sources: DataFrame, links: SplitEdges, n: int) -> DataFrame:
    """(id, share): what the shortest paths from ``sources`` add to each vertex on the way."""
    reached = _distances(sources, links)
    onward = links.send(reached.withColumnRenamed("v", "id"), "s", "d").select(
        "s", F.col("src").alias("u"), F.col("dst").alias("v"), F.col("d").alias("_from"), (F.col("d") + F.col("w")).alias("_via")
    )
    # a step goes on from the source, and no other route to its end is shorter
    steps = cut(
        onward.join(reached.select("s", "v", "d"), ["s", "v"])
        .where((F.col("_from") < F.col("d")) & ~_shorter(F.col("d"), F.col("_via")))
        .select("s", "u", "v")
    )
    one = reached.where(F.col("s") == F.col("v")).select("s", "v", F.lit(1.0).alias("x"))
    paths = _walk(one, steps, "u", "v", n)
    # what each target asks of the vertices before it, carried back along the steps
    asked = _walk(paths.select("s", "v", (1.0 / F.col("x")).alias("x")), steps, "v", "u", n)
    share = cut(
        asked.where(F.col("s") != F.col("v"))
        .join(paths.withColumnRenamed("x", "_paths"), ["s", "v"])
        .groupBy(F.col("v").alias("id"))
        .agg(F.sum(F.col("x") * F.col("_paths")).alias("share"))
    )
    discard(reached, steps, paths, asked)
    return share


def betweenness(
    vertices: DataFrame,
    edges: DataFrame,
    directed: bool = True,
    sources: DataFrame | None = None,
    weight_mode: str = "distance",
    normalised: bool = True,
    hub_edges: int = HEAVY_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, betweenness)``. ``sources`` limits the paths to those starting there, and scales up.

    Weights have to be positive. Edges with an end that is no vertex are left out. ``block`` bounds
    the state: that many sources times the vertices they reach.
    """
    if weight_mode not in ("distance", "inverse"):
        raise ValueError(f"unknown weight mode {weight_mode!r}")
    chosen = edges if weight_mode == "distance" else edges.withColumn("w", 1.0 / F.col("w"))
    numbers = numbered(vertices)
    inside = renumbered(chosen, numbers)
    links = SplitEdges(inside if directed else symmetric(inside), hub_edges)
    everyone, seen = settle(numbers.select(F.col("node").alias("id")), n=F.count(F.lit(1)))
    n = seen["n"]
    starts = everyone if sources is None else cut(named_nodes(sources, numbers))
    count = n if sources is None else starts.count()
    order = cut(global_rank(starts, ["id"], "_place"))

    total = None
    for first in range(0, count, block):
        here = order.where(F.col("_place").between(first, first + block - 1)).select("id")
        share = _dependencies(here, links, n)
        if total is None:
            total = share
            continue
        summed = cut(total.unionByName(share).groupBy("id").agg(F.sum("share").alias("share")))
        discard(total, share)
        total = summed
    links.release()
    factor = (n / count if count else 1.0) * (1.0 if directed else 0.5)
    if normalised and n > 2:
        factor /= (n - 1) * (n - 2) if directed else (n - 1) * (n - 2) / 2
    none = F.lit(0.0)
    scores = everyone.withColumn("share", none) if total is None else everyone.join(total, "id", "left")
    scores = scores.select("id", (F.coalesce("share", none) * F.lit(factor)).alias("betweenness"))
    return named(scores, numbers, "betweenness")


def named_nodes(sources: DataFrame, numbers: DataFrame) -> DataFrame:
    return sources.select("id").join(numbers, "id").select(F.col("node").alias("id"))

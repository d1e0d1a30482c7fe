"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.operators.graph.core import SplitEdges, named, numbered, renumbered, settle, symmetric
from adoptrend.operators.skew import HEAVY_ROWS, lookup
from adoptrend.session import discard

# pointer steps per round
JUMPS = 3


def components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 100, hub_edges: int = HEAVY_ROWS) -> DataFrame:
    """``(id, component)``: the smallest id of each vertex's component.

    All vertices with one label form a tree that moves as a whole: a round finds the smallest
    label next to each tree, follows those pointers a few steps, and relabels the vertices. Every
    tree with a neighbour merges in every round, so the rounds grow with the logarithm of the
    number of vertices, also on long paths. Late in the run most vertices share one label; the
    lookups treat such a label apart.
    """
    numbers = numbered(vertices)
    links = SplitEdges(symmetric(renumbered(edges, numbers)), hub_edges)
    state, seen = settle(
        numbers.select(F.col("node").alias("id"), F.col("node").alias("component")), n=F.count(F.lit(1))
    )
    n = seen["n"]
    for _ in range(max_rounds):
        heard = links.send(state, "component").select(F.col("dst").alias("id"), F.col("component").alias("_near"))
        around = (
            state.select("id", F.col("component").alias("_tree"), F.col("component").alias("_near"))
            .unionByName(heard, allowMissingColumns=True)
            .groupBy("id")
            .agg(F.max("_tree").alias("_tree"), F.min("_near").alias("_near"))
        )
        pointers, seen = settle(
            around.groupBy("_tree").agg(F.min("_near").alias("_to")),
            trees=F.count(F.lit(1)),
            moving=F.count_if(F.col("_to") != F.col("_tree")),
        )
        if not seen["moving"]:
            break
        first = pointers
        onward = first.select(F.col("_tree").alias("_to"), F.col("_to").alias("_further"))
        for _ in range(JUMPS):
            stepped = lookup(
                pointers, onward, "_to", seen["trees"], hub_edges, ("_tree", F.col("_further").alias("_to"))
            )
            if pointers is not first:
                discard(pointers)
            pointers = stepped
        labelled = state.withColumnRenamed("component", "_tree")
        moved = lookup(labelled, pointers, "_tree", n, hub_edges, ("id", F.col("_to").alias("component")))
        discard(state, first, pointers)
        state = moved
    else:
        links.release()
        raise RuntimeError(f"components still changing after {max_rounds} rounds")
    links.release()
    if dict(vertices.dtypes)["id"] == "bigint":
        return state
    least = numbers.select(F.col("node").alias("component"), F.col("id").alias("_least"))
    labelled = lookup(state, least, "component", n, hub_edges, ("id", F.col("_least").alias("component")))
    return named(labelled, numbers, "component")

"""PageRank and hub / authority scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.fixed import DAMPING
from adoptrend.operators.graph.core import (
    SplitEdges, endpoints, named, numbered, out_weights, renumbered, reverse, settle, symmetric,
)
from adoptrend.operators.skew import HEAVY_ROWS
from adoptrend.session import discard


# rounds after which ranks that still move are an error
MAX_ROUNDS = 1000
TOLERANCE = 1e-10


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    directed: bool = True,
    alpha: float = DAMPING,
    iters: int | None = None,
    tol: float = TOLERANCE,
    per_vertex: bool = False,
    max_rounds: int = MAX_ROUNDS,
    hub_edges: int = HEAVY_ROWS,
) -> DataFrame:
    """Weighted PageRank ``(id, pagerank)``; weights are strengths, ranks sum to 1.

    Vertices without outgoing edges give their rank to all vertices alike; edges with an end that
    is no vertex are left out. The rounds end once the summed change of all ranks is below ``tol``,
    and running out of ``max_rounds`` raises. ``iters`` asks for that many rounds instead.
    ``per_vertex`` is the looser rule of a common graph library, ``tol`` times the number of
    vertices: it depends on the size of the graph and is meant for comparisons only.
    """
    numbers = numbered(vertices)
    inside = renumbered(edges, numbers)
    links = SplitEdges(inside if directed else symmetric(inside), hub_edges)
    start = numbers.select(F.col("node").alias("id")).join(out_weights(links.edges).select("id", "out_w"), "id", "left")
    first, seen = settle(start, n=F.count(F.lit(1)), stranded=F.count_if(F.col("out_w").isNull()))
    n = seen["n"]
    if n == 0:
        links.release()
        return vertices.select("id", F.lit(0.0).alias("pagerank"))
    stranded = seen["stranded"] / n
    written, state = first, first.withColumn("rank", F.lit(1.0 / n))
    limit = n * tol if per_vertex else tol

    for _ in range(max_rounds if iters is None else iters):
        given = links.send(
            state.where(F.col("out_w").isNotNull()).withColumn("share", F.col("rank") / F.col("out_w")), "share"
        )
        base = (1 - alpha) / n + alpha * stranded / n
        # what a vertex receives and what it was meet in one aggregation instead of a join
        moved = (
            state.select("id", "out_w", "rank", F.lit(0.0).alias("_in"))
            .unionByName(
                given.select(F.col("dst").alias("id"), (F.col("share") * F.col("w")).alias("_in")),
                allowMissingColumns=True,
            )
            .groupBy("id")
            .agg(F.max("out_w").alias("out_w"), F.max("rank").alias("_before"), F.sum("_in").alias("_in"))
            .select("id", "out_w", "_before", (F.lit(base) + alpha * F.col("_in")).alias("rank"))
        )
        moved, seen = settle(
            moved,
            stranded=F.sum(F.when(F.col("out_w").isNull(), F.col("rank")).otherwise(0.0)),
            change=F.sum(F.abs(F.col("rank") - F.col("_before"))),
        )
        discard(written)
        written, state, stranded = moved, moved.drop("_before"), seen["stranded"]
        if iters is None and seen["change"] < limit:
            break
    else:
        if iters is None:
            links.release()
            raise RuntimeError(f"ranks still change by {seen['change']:.3g} in a round after {max_rounds} rounds")
    links.release()
    return named(state.select("id", F.col("rank").alias("pagerank")), numbers, "pagerank")


def hits(edges: DataFrame, iters: int = 15, hub_edges: int = HEAVY_ROWS) -> DataFrame:
    """Hub and authority scores ``(id, hub, authority)`` after ``iters`` rounds, each summing to 1 over the graph."""
    numbers = numbered(endpoints(edges))
    inside = renumbered(edges, numbers)
    forward, backward = SplitEdges(inside, hub_edges), SplitEdges(reverse(inside), hub_edges)

    def pass_on(links: SplitEdges, scores: DataFrame, scale: float):
        raw = (
            links.send(scores, "score")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("score") * F.col("w") * F.lit(scale)).alias("score"))
        )
        done, seen = settle(raw, total=F.sum("score"))
        return done, (1.0 / seen["total"] if seen["total"] else 0.0)

    hubs, hub_scale = forward.edges.select(F.col("src").alias("id")).distinct().withColumn("score", F.lit(1.0)), 1.0
    authorities, authority_scale = None, 1.0
    for _ in range(iters):
        before = (hubs, authorities)
        authorities, authority_scale = pass_on(forward, hubs, hub_scale)
        hubs, hub_scale = pass_on(backward, authorities, authority_scale)
        discard(*[x for x in before if x is not None])
    forward.release()
    backward.release()
    hub = hubs.select("id", (F.col("score") * hub_scale).alias("hub"))
    authority = authorities.select("id", (F.col("score") * authority_scale).alias("authority"))
    scores = hub.join(authority, "id", "full").fillna(0.0, subset=["hub", "authority"])
    return named(scores, numbers, "hub", "authority")

"""Modularity, and communities that raise it.

Leiden in rounds: vertices move to the neighbouring community that gains most; each community is
refined into parts that grew from single vertices and are well connected; the parts become the
vertices of the next, smaller graph, in the communities reached. All moves of one round are made at
once, so in each a community either takes vertices or gives some away, whichever the first of the
wishes that touch it calls for. A round looks only at the frontier, the vertices whose neighbourhood changed.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.fixed import SEED
from adoptrend.operators.graph.components import components
from adoptrend.operators.graph.core import SplitEdges, numbered, renumbered, settle, symmetric
from adoptrend.operators.ordered import global_rank
from adoptrend.operators.skew import HEAVY_ROWS
from adoptrend.session import cut, discard

GAIN = 1e-12


def modularity(labels: DataFrame, edges: DataFrame, hub_edges: int = HEAVY_ROWS) -> DataFrame:
    """One row: weighted modularity of ``labels(id, community)`` over undirected ``edges``."""
    links = SplitEdges(symmetric(edges), hub_edges)
    # one row per (vertex, neighbouring community) before the second label is joined
    toward = (
        links.send(labels, "community")
        .groupBy(F.col("dst").alias("id"), F.col("community").alias("_other"))
        .agg(F.sum("w").alias("w"))
    )
    per_community = (
        toward.join(labels, "id")
        .groupBy("community")
        .agg(F.sum(F.when(F.col("community") == F.col("_other"), F.col("w")).otherwise(0.0)).alias("inside"), F.sum("w").alias("deg"))
    )
    summed = per_community.agg(
        F.sum("inside").alias("inside"), F.sum(F.col("deg") * F.col("deg")).alias("squares"), F.sum("deg").alias("total")
    )
    done = cut(
        summed.select(
            (
                F.try_divide("inside", "total") - F.try_divide("squares", F.col("total") * F.col("total"))
            ).alias("modularity")
        )
    )
    links.release()
    return done


def _totals(state: DataFrame) -> DataFrame:
    return state.groupBy("community").agg(F.sum("k").alias("_tot"))


def _granted(wishes: DataFrame, turn: int, seed: int) -> DataFrame:
    """``(id, best)``: those of the wishes ``(id, mine, best)`` that go together.

    Every wish has a priority drawn anew each turn. A community gives or takes by the first of the
    wishes that touch it, and a wish is granted where its own community gives and the other takes. So
    no two vertices trade places and none joins what leaves at the same time; the first wish of all
    is always granted, and late in a run, when few are left, nearly all are.
    """
    drawn = F.struct(F.xxhash64("id", F.lit(seed), F.lit(turn)).alias("p"), "id")
    ends = F.array(
        F.struct(F.col("mine").alias("c"), F.lit(False).alias("takes"), drawn.alias("p")),
        F.struct(F.col("best").alias("c"), F.lit(True).alias("takes"), drawn.alias("p")),
    )
    roles = wishes.select(F.inline(ends)).groupBy("c").agg(F.max_by("takes", "p").alias("takes"))
    gives = roles.where("NOT takes").select(F.col("c").alias("mine"))
    takes = roles.where("takes").select(F.col("c").alias("best"))
    return wishes.join(gives, "mine", "left_semi").join(takes, "best", "left_semi").select("id", "best")


def _quality(state: DataFrame, links: SplitEdges, total: float) -> tuple[float, int]:
    """Modularity of ``state(id, k, inner, community)``, and the number of communities."""
    ends = links.send(state, "community").join(state.select(F.col("id").alias("dst"), F.col("community").alias("_c")), "dst")
    inside = ends.where(F.col("community") == F.col("_c")).agg(F.sum("w")).first()[0] or 0.0
    sums = state.groupBy("community").agg(F.sum("k").alias("k"), F.sum("inner").alias("inner"))
    row = sums.agg(F.sum("inner").alias("inner"), F.sum(F.col("k") * F.col("k")).alias("squares"), F.count("*").alias("n")).first()
    return (inside + row.inner) / total - row.squares / (total * total), row.n


def _move_round(state: DataFrame, links: SplitEdges, total: float, turn: int, seed: int) -> tuple[DataFrame, int]:
    """One round of moves; the next state, and how many vertices wanted to move.

    Only the vertices of the frontier (``active``) look at their neighbours. Next time it is those that
    could not go where they wanted, and the neighbours of those that moved.
    """
    active = state.where("active").select("id", "k", F.col("community").alias("_mine"))
    near = links.send(active, "k", "_mine").select(F.col("src").alias("id"), "dst", "w", "k", "_mine")
    near = near.join(state.select(F.col("id").alias("dst"), "community"), "dst").drop("dst")
    # staying is always on offer, also to a vertex without a neighbour in its own community
    own = active.select("id", F.lit(0.0).alias("w"), "k", "_mine", F.col("_mine").alias("community"))
    offers = (
        near.unionByName(own)
        .groupBy("id", "k", "_mine", "community")
        .agg(F.sum("w").alias("_to"))
        .join(_totals(state), "community")
    )
    stays = F.col("community") == F.col("_mine")
    rest = F.col("_tot") - F.when(stays, F.col("k")).otherwise(0.0)
    gain = F.round(F.col("_to") / total - F.col("k") * rest / (total * total), 15)
    offer = F.struct(gain.alias("gain"), (-F.col("community")).alias("minus"))
    rated = offers.groupBy("id", "_mine").agg(F.max(F.when(stays, gain)).alias("_stay"), F.max(offer).alias("_top"))
    wishes, seen = settle(
        rated.where(F.col("_top.gain") > F.col("_stay") + GAIN).select("id", F.col("_mine").alias("mine"), (-F.col("_top.minus")).alias("best")),
        wanting=F.count(F.lit(1)),
    )
    if not seen["wanting"]:
        discard(wishes)
        return state, 0
    movers = _granted(wishes, turn, seed)
    woken = links.send(movers, "best").select(F.col("dst").alias("id"), "best")
    woken = woken.join(state.select("id", "community"), "id").where(F.col("community") != F.col("best")).select("id")
    again = wishes.join(movers, "id", "left_anti").select("id")
    frontier = woken.union(again).distinct().withColumn("active", F.lit(True))
    after = cut(
        state.drop("active")
        .join(movers, "id", "left")
        .join(frontier, "id", "left")
        .select("id", "k", "inner", F.coalesce("best", "community").alias("community"), F.coalesce("active", F.lit(False)).alias("active"))
    )
    discard(wishes)
    return after, seen["wanting"]


def _refined(state: DataFrame, links: SplitEdges, total: float, max_rounds: int, seed: int) -> DataFrame:
    """``(id, part)``: connected parts of the communities, grown from single vertices.

    A vertex that is still alone and well connected within its community joins the part there, itself
    well connected, that gains most; it never moves again.
    """
    ends = links.send(state, "community").join(state.select(F.col("id").alias("dst"), F.col("community").alias("_c")), "dst")
    inside = cut(ends.where(F.col("community") == F.col("_c")).select("src", "dst", "w"))
    sums = inside.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("_in"))
    fits = F.coalesce("_in", F.lit(0.0)) + GAIN >= F.col("k") * (F.col("_tot") - F.col("k")) / total
    parts = cut(
        state.join(sums, "id", "left").join(_totals(state), "community")
        .select("id", "k", "_tot", F.col("id").alias("part"), fits.alias("alone"))
    )
    for turn in range(max_rounds):
        side = lambda end, name: parts.select(F.col("id").alias(end), F.col("part").alias(name))
        across = inside.join(side("src", "_p"), "src").join(side("dst", "_q"), "dst").where(F.col("_p") != F.col("_q"))
        across = cut(across.groupBy("src", "_p", "_q").agg(F.sum("w").alias("w")))
        outward = across.groupBy(F.col("_p").alias("part")).agg(F.sum("w").alias("_out"))
        sized = parts.groupBy("part").agg(F.sum("k").alias("_k"), F.max("_tot").alias("_tot"))
        good = sized.join(outward, "part").where(F.col("_out") + GAIN >= F.col("_k") * (F.col("_tot") - F.col("_k")) / total)
        alone = parts.where("alone").select(F.col("id").alias("src"), "k")
        gain = F.round(F.col("w") / total - F.col("k") * F.col("_k") / (total * total), 15)
        offers = (
            across.select("src", "_q", "w").join(alone, "src").join(good.select(F.col("part").alias("_q"), "_k"), "_q")
            .withColumn("_gain", gain)
            .where(F.col("_gain") > GAIN)
        )
        offer = F.struct("_gain", (-F.col("_q")).alias("_minus"))
        wishes, seen = settle(
            offers.groupBy(F.col("src").alias("id")).agg(F.max(offer).alias("_best")).select(
                "id", F.col("id").alias("mine"), (-F.col("_best._minus")).alias("best")
            ),
            wanting=F.count(F.lit(1)),
        )
        discard(across)
        if seen["wanting"]:
            joins = _granted(wishes, turn, seed)
            taken = joins.select(F.col("best").alias("id")).distinct().withColumn("_taken", F.lit(True))
            grown = cut(
                parts.join(joins, "id", "left").join(taken, "id", "left").select(
                    "id", "k", "_tot", F.coalesce("best", "part").alias("part"),
                    (F.col("alone") & F.col("best").isNull() & F.col("_taken").isNull()).alias("alone"),
                )
            )
            discard(parts)
            parts = grown
        discard(wishes)
        if not seen["wanting"]:
            break
    else:
        warnings.warn(f"communities: {seen['wanting']} vertices still want to join a part after {max_rounds} rounds", stacklevel=3)
    discard(inside)
    return parts


def communities(
    vertices: DataFrame, edges: DataFrame, max_rounds: int = 200, max_levels: int = 100, seed: int = SEED, hub_edges: int = HEAVY_ROWS
) -> DataFrame:
    """``(id, community_id)``: connected communities, 0 the largest, ties by the smallest id.

    Levels end when no vertex moves, or when merging raises modularity no more. A run that ends at
    ``max_rounds`` or ``max_levels`` instead says so in a warning. Edges of no weight count for nothing.
    """
    numbers = numbered(vertices)
    both = symmetric(renumbered(edges, numbers)).where("w > 0").groupBy("src", "dst").agg(F.sum("w").alias("w"))
    both = cut(both)
    loops = both.where("src = dst").select(F.col("src").alias("id"), F.col("w").alias("inner"))
    strength = both.groupBy(F.col("src").alias("id")).agg(F.sum("w").alias("k"))
    # vertices without an edge stay alone and take no part
    start = strength.join(loops, "id", "left").select(
        "id", "k", F.coalesce("inner", F.lit(0.0)).alias("inner"), F.col("id").alias("community"), F.lit(True).alias("active")
    )
    state, seen = settle(start, total=F.sum("k"), n=F.count(F.lit(1)))
    total, n = seen["total"], seen["n"]
    links = SplitEdges(both.where("src <> dst"), hub_edges)
    members = cut(state.select(F.col("id").alias("node"), "id"))
    best, quality, whole = None, None, True
    for level in range(max_levels if total else 0):
        for turn in range(max_rounds):
            after, wanting = _move_round(state, links, total, turn, seed + level)
            if not wanting:
                break
            discard(state)
            state = after
        else:
            warnings.warn(f"communities: {wanting} vertices still want to move after {max_rounds} rounds", stacklevel=2)
        reached, several = _quality(state, links, total)
        # a community that is not one vertex of this level may have been torn apart by moves
        whole = several == n
        if quality is not None and reached <= quality + GAIN:
            break
        if best is not None:
            discard(best)
        best = cut(members.join(state.select("id", "community"), "id").select("node", "community"))
        quality = reached
        if whole:
            break
        parts = _refined(state, links, total, max_rounds, seed + level)
        # `part` is also a column of the split edges
        grown = parts.select("id", F.col("part").alias("_part"))
        onward = cut(members.join(grown, "id").select("node", F.col("_part").alias("id")))
        crossing = (
            links.send(grown, "_part")
            .groupBy("dst", F.col("_part").alias("_a")).agg(F.sum("w").alias("w"))
            .join(grown.select(F.col("id").alias("dst"), F.col("_part").alias("_b")), "dst")
            .groupBy(F.col("_a").alias("src"), F.col("_b").alias("dst")).agg(F.sum("w").alias("w"))
        )
        crossing = cut(crossing)
        within = crossing.where("src = dst").select(F.col("src").alias("id"), F.col("w").alias("_within"))
        merged = (
            state.join(grown, "id")
            .groupBy(F.col("_part").alias("id"))
            .agg(F.sum("k").alias("k"), F.sum("inner").alias("inner"), F.max("community").alias("community"))
            .join(within, "id", "left")
            .select("id", "k", (F.col("inner") + F.coalesce("_within", F.lit(0.0))).alias("inner"), "community", F.lit(True).alias("active"))
        )
        above, seen = settle(merged, n=F.count(F.lit(1)))
        links.release()
        discard(state, members, parts)
        state, members = above, onward
        links = SplitEdges(crossing.where("src <> dst"), hub_edges)
        discard(crossing)
        if seen["n"] == n:
            break
        n = seen["n"]
    else:
        if total:
            warnings.warn(f"communities: modularity still grows after {max_levels} levels", stacklevel=2)
    links.release()
    if best is not None and not whole:
        torn = both.join(best.select(F.col("node").alias("src"), F.col("community").alias("_a")), "src")
        torn = torn.join(best.select(F.col("node").alias("dst"), F.col("community").alias("_b")), "dst").where("_a = _b AND src < dst")
        parts = components(best.select(F.col("node").alias("id")), torn.select("src", "dst", "w"), hub_edges=hub_edges)
        best = parts.select(F.col("id").alias("node"), F.col("component").alias("community"))

    found = numbers if best is None else numbers.join(best, "node", "left")
    label = F.col("node") if best is None else F.coalesce("community", "node")
    named = cut(found.select("id", label.alias("community")))
    sized = named.groupBy("community").agg(F.count("*").alias("_size"), F.min("id").alias("_first"))
    ranked = global_rank(sized.withColumn("_smaller", -F.col("_size")), ["_smaller", "_first"], "community_id")
    done = cut(named.join(ranked.select("community", "community_id"), "community").select("id", "community_id"))
    discard(state, members, both, named, *([best] if best is not None else []))
    return done

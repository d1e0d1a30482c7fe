from __future__ import annotations

import itertools
import os
import random

import numpy as np
import pytest

from adoptrend.operators import actors
from adoptrend.operators.graph import betweenness as between
from adoptrend.operators.graph import community, components, core, rank
from adoptrend.plans import graphs
from adoptrend.session import shared_dir

TRIANGLES = [(1, 2), (2, 3), (1, 3), (3, 4), (4, 5), (5, 6), (4, 6)]


def graph(spark, edges, vertices=None):
    weighted = [(a, b, float(w[0]) if w else 1.0) for a, b, *w in edges]
    ids = sorted({x for a, b, _ in weighted for x in (a, b)} | set(vertices or ()))
    kind = "string" if isinstance(ids[0], str) else "long"
    return (
        spark.createDataFrame([(i,) for i in ids], f"id {kind}"),
        spark.createDataFrame(weighted, f"src {kind}, dst {kind}, w double"),
    )


def values(df):
    return {r[0]: r[1] for r in df.collect()}


def test_pagerank_directed_dangling(spark):
    got = values(rank.pagerank(*graph(spark, [("a", "b")]), iters=60))
    assert got["a"] == pytest.approx(0.350877, abs=1e-6) and got["b"] == pytest.approx(0.649123, abs=1e-6)


def test_pagerank_undirected_isolated(spark):
    v, e = graph(spark, [("a", "b")], ["c"])
    got = values(rank.pagerank(v, e, directed=False, iters=100, tol=1e-10))
    assert got["a"] == pytest.approx(0.465116, abs=1e-6) and got["c"] == pytest.approx(0.069767, abs=1e-6)
    assert sum(got.values()) == pytest.approx(1.0)


def random_digraph(seed, n=12, m=40):
    pick = random.Random(seed)
    pairs = pick.sample([(a, b) for a in range(n) for b in range(n) if a != b], m)
    return [(a, b, pick.randint(1, 4)) for a, b in pairs]


def dense_pagerank(edges, n, iters, alpha=0.85):
    w = np.zeros((n, n))
    for a, b, x in edges:
        w[a, b] = x
    out, r = w.sum(axis=1), np.full(n, 1 / n)
    for _ in range(iters):
        share = np.divide(r, out, out=np.zeros(n), where=out > 0)
        r = (1 - alpha) / n + alpha * (w.T @ share + r[out == 0].sum() / n)
    return r


def test_pagerank_with_split_hubs(spark):
    edges = random_digraph(3) + [(20, i, 1) for i in range(12)] + [(i, 21, 2) for i in range(12)]
    ids = sorted({x for a, b, _ in edges for x in (a, b)})
    place = {v: i for i, v in enumerate(ids)}
    expected = dense_pagerank([(place[a], place[b], w) for a, b, w in edges], len(ids), 12)
    for limit in (100_000, 3):
        got = values(rank.pagerank(*graph(spark, edges), iters=12, hub_edges=limit))
        assert [got[i] for i in ids] == pytest.approx(list(expected))


def test_pagerank_keeps_to_its_vertices_and_converges(spark):
    v = spark.createDataFrame([("a",), ("b",)], "id string")
    _, e = graph(spark, [("a", "b"), ("b", "x")])
    got = values(rank.pagerank(v, e))
    assert set(got) == {"a", "b"} and sum(got.values()) == pytest.approx(1.0)
    assert got["b"] == pytest.approx(0.649123, abs=1e-6)
    edges = random_digraph(4)
    expected = dense_pagerank(edges, 12, 300)
    v, e = graph(spark, edges, range(12))
    got = values(rank.pagerank(v, e, tol=1e-9))
    assert [got[i] for i in range(12)] == pytest.approx(list(expected), abs=1e-8)
    with pytest.raises(RuntimeError, match="still change"):
        rank.pagerank(v, e, max_rounds=3)


def test_pagerank_stops_alike_at_any_size(spark):
    # many isolated vertices: the rule by vertex ends after a round or two, the total does not
    edges = [(a, b, w) for a, b, w in random_digraph(4)]
    v, e = graph(spark, edges, range(3000))
    exact = dense_pagerank(edges, 3000, 300)
    got = values(rank.pagerank(v, e, tol=1e-9))
    assert max(abs(got[i] / exact[i] - 1) for i in range(12)) < 1e-6
    loose = values(rank.pagerank(v, e, tol=1e-6, per_vertex=True))
    assert max(abs(loose[i] / exact[i] - 1) for i in range(12)) > 1e-3


def test_rounds_leave_no_tables(spark):
    def tables():
        return {f for top, _, _ in os.walk(shared_dir(spark).removeprefix("file:")) if (f := top) and os.path.basename(f).startswith("cut-")}

    edges = [(f"n{a}", f"n{b}", w) for a, b, w in random_digraph(6)]
    v, e = graph(spark, edges)
    for run in (
        lambda: rank.pagerank(v, e, iters=8),
        lambda: components.components(v, e),
        lambda: rank.hits(e, iters=6),
    ):
        before = tables()
        kept = run()
        # numbers, the last round's table, and what the last lookups read
        assert len(tables() - before) <= 6
        assert kept.count() == v.count()


def test_split_edges_marks_heavy_sources(spark):
    _, e = graph(spark, [(0, i) for i in range(1, 40)] + [(50, 51)])
    links = core.SplitEdges(e, 10)
    assert links.heavy.collect()[0].asDict() == {"src": 0, "_parts": 4}
    assert links.edges.where("src = 0").select("part").distinct().count() == 4
    sent = links.send(spark.createDataFrame([(0, 1.0), (50, 2.0)], "id long, x double"), "x")
    assert sent.count() == 40


def test_hits(spark):
    edges = [("a", "x", 1), ("a", "y", 1), ("b", "x", 1)]
    scores = {r.id: (r.hub, r.authority) for r in rank.hits(graph(spark, edges)[1], iters=40).collect()}
    a = np.array([[1.0, 1.0], [1.0, 0.0]])
    principal = np.abs(np.linalg.eigh(a @ a.T)[1][:, -1])
    assert scores["a"][0] == pytest.approx(principal[0] / principal.sum(), abs=1e-6)
    assert sum(h for h, _ in scores.values()) == pytest.approx(1) and scores["a"][1] == 0


def test_components(spark):
    v, e = graph(spark, [(i, i + 1) for i in range(1, 30)] + [(100, 101), (101, 102)], [7, 500])
    for limit in (100_000, 2):
        got = values(components.components(v, e, hub_edges=limit))
        assert {got[i] for i in range(1, 31)} == {1}
        assert got[102] == 100 and got[500] == 500


def test_degree(spark):
    v, e = graph(spark, [(1, 2), (2, 3)], [9])
    assert values(core.degree(v, core.symmetric(e))) == {1: 1, 2: 2, 3: 1, 9: 0}


def brute_betweenness(ids, edges, directed):
    """All simple paths of every ordered pair; enough for small graphs."""
    steps = {}
    for a, b, w in edges:
        steps.setdefault(a, []).append((b, w))
        if not directed:
            steps.setdefault(b, []).append((a, w))
    score = dict.fromkeys(ids, 0.0)
    for s, t in itertools.permutations(ids, 2):
        found = []

        def walk(at, seen, length):
            if at == t:
                found.append((length, seen))
                return
            for nxt, w in steps.get(at, ()):
                if nxt not in seen:
                    walk(nxt, [*seen, nxt], length + w)

        walk(s, [s], 0)
        if found:
            shortest = min(d for d, _ in found)
            best = [p for d, p in found if d == shortest]
            for p in best:
                for v in p[1:-1]:
                    score[v] += 1 / len(best)
    n = len(ids)
    return {v: x / ((n - 1) * (n - 2)) for v, x in score.items()}


def test_betweenness_small_shapes(spark):
    path = values(between.betweenness(*graph(spark, [("a", "b"), ("b", "c")]), directed=False))
    assert path == {"a": 0, "b": 1, "c": 0}
    star = values(between.betweenness(*graph(spark, [(0, i) for i in range(1, 5)]), directed=False))
    assert star[0] == pytest.approx(1) and star[1] == 0
    two = values(between.betweenness(*graph(spark, TRIANGLES), directed=False))
    assert two[3] == pytest.approx(0.6) and two[4] == pytest.approx(0.6) and two[1] == 0


def test_betweenness_directed_ties_and_modes(spark):
    free = [("a", "b", 1), ("b", "c", 1), ("a", "c", 3)]
    assert values(between.betweenness(*graph(spark, free)))["b"] == pytest.approx(0.5)
    tied = [("a", "b", 1), ("b", "c", 1), ("a", "c", 2)]
    assert values(between.betweenness(*graph(spark, tied)))["b"] == pytest.approx(0.25)
    assert values(between.betweenness(*graph(spark, free), weight_mode="inverse"))["b"] == 0
    # routes that differ by one in a hundred thousand are no tie
    strong = [("s", "a", 100_000), ("a", "t", 100_000), ("s", "b", 100_001), ("b", "t", 100_001)]
    got = values(between.betweenness(*graph(spark, strong), weight_mode="inverse", normalised=False))
    assert (got["a"], got["b"]) == (0.0, 1.0)
    # distances far below any fixed tolerance still lead away from the source
    tiny = [("a", "b", 1e-12), ("b", "c", 1e-12), ("c", "a", 1e-12), ("c", "d", 1e-12)]
    got = values(between.betweenness(*graph(spark, tiny), normalised=False))
    assert got == {"a": 1.0, "b": 2.0, "c": 3.0, "d": 0.0}


@pytest.mark.parametrize("directed", [True, False])
def test_betweenness_against_all_paths(spark, directed):
    edges = random_digraph(5, n=7, m=14)
    if not directed:
        edges = list({(min(a, b), max(a, b)): (min(a, b), max(a, b), w) for a, b, w in edges}.values())
    v, e = graph(spark, edges)
    expected = brute_betweenness(sorted({x for a, b, _ in edges for x in (a, b)}), edges, directed)
    got = values(between.betweenness(v, e, directed=directed, hub_edges=2, block=3))
    assert got == pytest.approx(expected)
    whole = values(between.betweenness(v, e, directed=directed, sources=v))
    assert whole == pytest.approx(expected)


def test_modularity_of_triangles(spark):
    _, e = graph(spark, TRIANGLES)
    labels = spark.createDataFrame([(i, 0 if i < 4 else 1) for i in range(1, 7)], "id long, community long")
    assert community.modularity(labels, e).first()[0] == pytest.approx(0.357143, abs=1e-6)


def test_communities_of_triangles(spark):
    v, e = graph(spark, TRIANGLES, [9])
    got = values(community.communities(v, e))
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 1, 6: 1, 9: 2}


def test_communities_of_planted_groups(spark):
    pick = random.Random(1)
    edges = [
        (a, b) for a, b in itertools.combinations(range(40), 2) if pick.random() < (0.6 if a // 10 == b // 10 else 0.02)
    ]
    v, e = graph(spark, edges, range(42))
    found = community.communities(v, e, hub_edges=5)
    labels = values(found)
    assert set(labels) == set(range(42))
    assert sorted(set(labels.values())) == list(range(len(set(labels.values()))))
    for start in range(0, 40, 10):
        assert len({labels[i] for i in range(start, start + 10)}) == 1
    assert len({labels[40], labels[41]} | {labels[i] for i in range(40)}) == 6
    # connected, and at least as good as the planted grouping
    relabelled = found.withColumnRenamed("community_id", "community")
    planted = spark.createDataFrame([(i, i // 10) for i in range(42)], "id long, community long")
    assert community.modularity(relabelled, e).first()[0] >= community.modularity(planted, e).first()[0] - 1e-9
    for c in set(labels.values()):
        inside = {i for i, x in labels.items() if x == c}
        reached, front = set(), {min(inside)}
        while front:
            reached |= front
            front = {y for a, b in edges for x, y in ((a, b), (b, a)) if x in front and y in inside} - reached
        assert reached == inside


def facts(spark, data):
    return spark.createDataFrame(data, "dev_id string, repo_name string, year string, commit_count long")


def test_co_edges(spark, rows):
    data = [
        ("a", "r", "2020", 1), ("b", "r", "2020", 1), ("a", "r", "2021", 1), ("b", "r", "2021", 1),
        ("a", "q", "2020", 1), ("c", "q", "2021", 1),
    ]
    data += [(f"h{i}", "hub", "2020", 1) for i in range(6)] + [(f"h{i}", "other", "2020", 1) for i in range(2)]
    edges = facts(spark, data)
    stats = actors.actor_stats(edges, 1, 10)
    members = actors.hubless(actors.membership(edges, actors.top_actors(stats)), 5)
    assert "hub" not in {r.repo_name for r in members.collect()}
    # a repository shared in two years counts once, and one touched in different years not at all
    assert rows(actors.co_edges(members)) == [("a", "b", 1), ("h0", "h1", 1)]
    assert rows(actors.top_actors(stats, 2), "dev_id", "distinct_repos") == [("a", 2), ("h0", 2)]
    assert rows(actors.top_actors(stats, 4), "dev_id") == [("a",), ("b",), ("h0",), ("h1",)]
    assert actors.top_actors(stats, 0).count() == 0 and actors.top_actors(stats, 99).count() == stats.count()


def test_registered_communities_end_when_no_vertex_wants_to_move(monkeypatch):
    class Tables:
        actor_vertices = actor_graph = None

    given = []
    monkeypatch.setattr(community, "communities", lambda *tables, **bounds: given.append(bounds))
    graphs.found_communities(Tables())
    assert given == [{}], "no gain thresholds"


def partitions(items):
    if not items:
        yield []
        return
    first, *rest = items
    for smaller in partitions(rest):
        yield [[first], *smaller]
        for i, group in enumerate(smaller):
            yield [*smaller[:i], [first, *group], *smaller[i + 1 :]]


def brute_modularity(edges, groups):
    total = 2 * sum(w for _, _, w in edges)
    of = {v: i for i, g in enumerate(groups) for v in g}
    inside = sum(2 * w for a, b, w in edges if of[a] == of[b])
    degree = [sum(w * ((a in g) + (b in g)) for a, b, w in edges) for g in groups]
    return inside / total - sum((d / total) ** 2 for d in degree)


def test_communities_near_the_best_of_all_partitions(spark):
    pick = random.Random(4)
    edges = [(a, b, pick.randrange(1, 5)) for a, b in itertools.combinations(range(8), 2) if pick.random() < 0.4]
    edges.append((0, 0, 2))  # a loop
    v, e = graph(spark, edges, range(8))
    labels = values(community.communities(v, e))
    found = [[i for i in range(8) if labels[i] == c] for c in set(labels.values())]
    best = max(brute_modularity(edges, p) for p in partitions(list(range(8))))
    assert brute_modularity(edges, found) >= best - 0.02


def test_communities_follow_a_chain_of_cliques(spark):
    # rings of cliques with single links between them: every clique stays whole, over several levels
    edges = []
    for c in range(12):
        edges += itertools.combinations(range(5 * c, 5 * c + 5), 2)
        edges.append((5 * c + 4, 5 * ((c + 1) % 12)))
    v, e = graph(spark, edges)
    labels = values(community.communities(v, e, hub_edges=3))
    assert all(len({labels[5 * c + i] for i in range(5)}) == 1 for c in range(12))
    assert 3 <= len(set(labels.values())) <= 12
    ids = spark.createDataFrame([(i, i // 5) for i in range(60)], "id long, community long")
    found = spark.createDataFrame(list(labels.items()), "id long, community long")
    assert community.modularity(found, e).first()[0] >= community.modularity(ids, e).first()[0] - 1e-9


def test_communities_merge_small_cliques_on_a_higher_level(spark):
    # a ring of 24 triangles: single vertices stop at triangles, pairs of triangles have more
    inner = [(3 * g + a, 3 * g + b, 1.0) for g in range(24) for a, b in ((0, 1), (0, 2), (1, 2))]
    ring = [(3 * g + 2, (3 * g + 3) % 72, 1.0) for g in range(24)]
    v = spark.createDataFrame([(i,) for i in range(72)], "id long")
    e = spark.createDataFrame(inner + ring, "src long, dst long, w double")
    labels = values(community.communities(v, e))
    assert all(len({labels[3 * g + a] for a in range(3)}) == 1 for g in range(24))
    found = spark.createDataFrame(list(labels.items()), "id long, community long")
    triangles = spark.createDataFrame([(i, i // 3) for i in range(72)], "id long, community long")
    assert community.modularity(found, e).first()[0] > community.modularity(triangles, e).first()[0] + 0.01


def test_split_edges_refuse_a_clashing_column(spark):
    e = spark.createDataFrame([(1, 2, 1.0)], "src long, dst long, w double")
    links = core.SplitEdges(e)
    with pytest.raises(ValueError, match="part"):
        links.send(spark.createDataFrame([(1, 7)], "id long, part long"), "part")
    links.release()


def test_communities_without_edges(spark):
    v, e = graph(spark, [(1, 2)], [3])
    none = e.limit(0)
    assert values(community.communities(v, none)) == {1: 0, 2: 1, 3: 2}
    assert values(community.communities(v.limit(0), none)) == {}

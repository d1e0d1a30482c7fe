"""The migration graph and the co-contribution graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.operators import actors, migration
from adoptrend.operators.graph import betweenness as between
from adoptrend.operators.graph import components as comps
from adoptrend.operators.graph import community, core, rank
from adoptrend.operators.ordered import global_rank
from adoptrend.plans.registry import query
from adoptrend.plans.trending import rounded
from adoptrend.session import cut
from adoptrend.sources.inputs import EDGE_WEIGHT, Inputs, with_views


@query("pseudonymised_edges", with_views("actor_facts", body="SELECT * FROM actor_facts"))
def pseudonymised_edges(t: Inputs) -> DataFrame:
    return actors.clean_actor_edges(t.developer_repos, last_year="2000")


@query("actor_stats", with_views("actor_stats", body="SELECT * FROM actor_stats"))
def actor_stats(t: Inputs) -> DataFrame:
    return t.actor_stats


@query(
    "top_actors",
    with_views("actor_stats", body="SELECT * FROM actor_stats ORDER BY distinct_repos DESC, dev_id LIMIT 500"),
)
def top_actors(t: Inputs) -> DataFrame:
    return actors.top_actors(t.actor_stats, 500)


@query("hubless_membership", with_views("members", body="SELECT * FROM members"))
def hubless_membership(t: Inputs) -> DataFrame:
    return t.members


@query("co_edges", with_views("co_edges", body="SELECT * FROM co_edges"))
def co_edges(t: Inputs) -> DataFrame:
    return t.co_edges


@query("migration_edges", with_views("migration_edges", body="SELECT * FROM migration_edges"))
def migration_edges(t: Inputs) -> DataFrame:
    return t.migration_edges


PERIODS = (("full", None, None), ("early", None, 1995), ("mid", 1997, 1999), ("late", 2001, None))


@query(
    "edges_by_period",
    with_views(
        "migration_signals",
        extra={
            "edges": """SELECT from_tech, to_tech, CAST(sum(migration_count) AS BIGINT) AS migration_count,
                               count(DISTINCT year) AS years_active, min(year) AS first_year, max(year) AS last_year
                        FROM migration_signals GROUP BY 1, 2"""
        },
        body="""SELECT *, 'full' AS period FROM edges
                UNION ALL SELECT *, 'early' FROM edges WHERE CAST(first_year AS INT) <= 1995
                UNION ALL SELECT *, 'mid' FROM edges WHERE CAST(last_year AS INT) >= 1997 AND CAST(first_year AS INT) <= 1999
                UNION ALL SELECT *, 'late' FROM edges WHERE CAST(last_year AS INT) >= 2001""",
    ),
)
def edges_by_period(t: Inputs) -> DataFrame:
    return migration.edges_by_period(migration.edge_rollup(t.migration_signals, 1), PERIODS)


@query("node_flow", with_views("node_flow", body="SELECT * FROM node_flow"))
def node_flow(t: Inputs) -> DataFrame:
    return migration.node_flow(t.migration_edges)


@query(
    "win_loss",
    with_views(
        "node_flow",
        body="""SELECT *, round(in_weight / CAST(in_weight + out_weight AS DOUBLE), 6) AS win_ratio,
                       CASE WHEN net_flow > 0 THEN 'winner' WHEN net_flow < 0 THEN 'loser' ELSE 'even' END AS verdict
                FROM node_flow""",
    ),
)
def win_loss(t: Inputs) -> DataFrame:
    return rounded(migration.win_loss(migration.node_flow(t.migration_edges)), "win_ratio")


@query(
    "flow_normalised",
    with_views(
        "node_flow",
        body="""SELECT tech, net_flow, round((net_flow - min(net_flow) OVER ())
                       / (max(net_flow) OVER () - min(net_flow) OVER () + CAST(1e-9 AS DOUBLE)), 6) AS scaled FROM node_flow""",
    ),
)
def flow_normalised(t: Inputs) -> DataFrame:
    return rounded(migration.flow_normalised(migration.node_flow(t.migration_edges)), "scaled")


@query(
    "edges_net_direction",
    with_views(
        "migration_edges",
        body="""SELECT a.from_tech, a.to_tech, a.migration_count,
                       a.migration_count - coalesce(b.migration_count, 0) AS net_count
                FROM migration_edges a LEFT JOIN migration_edges b ON a.from_tech = b.to_tech AND a.to_tech = b.from_tech
                WHERE b.migration_count IS NULL OR a.migration_count > b.migration_count
                   OR (a.migration_count = b.migration_count AND a.from_tech < a.to_tech)""",
    ),
)
def edges_net_direction(t: Inputs) -> DataFrame:
    return migration.net_direction(t.migration_edges)


@query(
    "top_edges",
    with_views(
        "migration_edges",
        body="""SELECT from_tech || ' → ' || to_tech AS pair, from_tech, to_tech, migration_count FROM migration_edges
                ORDER BY migration_count DESC, from_tech, to_tech LIMIT 15""",
    ),
)
def top_edges(t: Inputs) -> DataFrame:
    return migration.top_edges(t.migration_edges)


def pagerank_views(vertices: str, links: str, iters: int, alpha: float = 0.85) -> dict[str, str]:
    """One view per round; the last one is ``ranks``."""
    views = {
        "ow": f"SELECT src AS id, sum(w) AS out_w FROM {links} GROUP BY 1",
        "pv": f"SELECT id, out_w, 1.0 / (SELECT count(*) FROM {vertices}) AS r FROM {vertices} LEFT JOIN ow USING (id)",
    }
    before = "pv"
    for i in range(1, iters + 1):
        name = "ranks" if i == iters else f"pr{i}"
        views[name] = f"""
            SELECT v.id, v.out_w, {1 - alpha!r} / (SELECT count(*) FROM {before})
                   + {alpha} * (SELECT coalesce(sum(r), 0) FROM {before} WHERE out_w IS NULL) / (SELECT count(*) FROM {before})
                   + {alpha} * coalesce(g.r, 0) AS r
            FROM {before} v LEFT JOIN (SELECT dst, sum(p.r * w / p.out_w) AS r FROM {links} JOIN {before} p ON p.id = src
                                       GROUP BY 1) g ON g.dst = v.id"""
        before = name
    return views


@query(
    "pagerank_directed",
    with_views(
        "migration_links",
        "migration_vertices",
        extra=pagerank_views("migration_vertices", "migration_links", 20),
        body="SELECT id AS tech, round(r, 8) AS pagerank FROM ranks",
    ),
)
def pagerank_directed(t: Inputs) -> DataFrame:
    ranks = rank.pagerank(migration_vertices(t), t.migration_graph, directed=True, iters=20)
    return ranks.select(F.col("id").alias("tech"), F.round("pagerank", 8).alias("pagerank"))


# 0.85 ** 150 is far below what eight decimals show
@query(
    "pagerank_converged",
    with_views(
        "migration_links",
        "migration_vertices",
        extra=pagerank_views("migration_vertices", "migration_links", 150),
        body="SELECT id AS tech, round(r, 8) AS pagerank FROM ranks",
    ),
)
def pagerank_converged(t: Inputs) -> DataFrame:
    ranks = rank.pagerank(migration_vertices(t), t.migration_graph, directed=True, tol=1e-11)
    return ranks.select(F.col("id").alias("tech"), F.round("pagerank", 8).alias("pagerank"))


def migration_vertices(t: Inputs) -> DataFrame:
    return core.endpoints(t.migration_graph)


@query(
    "pagerank_undirected",
    with_views(
        "actor_links",
        "actor_vertices",
        extra=pagerank_views("actor_vertices", "actor_links", 15),
        body="SELECT id AS dev_id, round(r, 10) AS pagerank FROM ranks",
    ),
)
def pagerank_undirected(t: Inputs) -> DataFrame:
    ranks = rank.pagerank(t.actor_vertices, t.actor_graph, directed=False, iters=15)
    return ranks.select(F.col("id").alias("dev_id"), F.round("pagerank", 10).alias("pagerank"))


def hits_views(links: str, iters: int) -> dict[str, str]:
    views = {"h0": f"SELECT DISTINCT src AS id, CAST(1 AS DOUBLE) AS s FROM {links}"}
    for i in range(1, iters + 1):
        views[f"a{i}"] = f"""SELECT id, s / sum(s) OVER () AS s FROM
            (SELECT dst AS id, sum(h.s * w) AS s FROM {links} JOIN h{i - 1} h ON h.id = src GROUP BY 1)"""
        views[f"h{i}"] = f"""SELECT id, s / sum(s) OVER () AS s FROM
            (SELECT src AS id, sum(a.s * w) AS s FROM {links} JOIN a{i} a ON a.id = dst GROUP BY 1)"""
    return views


@query(
    "hits_directed",
    with_views(
        "migration_links",
        extra=hits_views("migration_links", 15),
        body="""SELECT coalesce(h15.id, a15.id) AS tech, round(coalesce(h15.s, 0), 8) AS hub,
                       round(coalesce(a15.s, 0), 8) AS authority FROM h15 FULL JOIN a15 ON h15.id = a15.id""",
    ),
)
def hits_directed(t: Inputs) -> DataFrame:
    scores = rank.hits(t.migration_graph, iters=15)
    return scores.select(
        F.col("id").alias("tech"), F.round("hub", 8).alias("hub"), F.round("authority", 8).alias("authority")
    )


REACH = {
    "reach": """SELECT id, id AS label FROM actor_vertices
                UNION SELECT dst, label FROM reach JOIN actor_links ON src = id"""
}


@query(
    "connected_components",
    with_views(
        "actor_vertices",
        "actor_links",
        extra=REACH,
        recursive=True,
        body="SELECT id AS dev_id, min(label) AS component FROM reach GROUP BY 1",
    ),
)
def connected_components(t: Inputs) -> DataFrame:
    return comps.components(t.actor_vertices, t.actor_graph).withColumnRenamed("id", "dev_id")


def betweenness_views(vertices: str, links: str, hops: int) -> dict[str, str]:
    """Shortest distances, path counts and dependencies, hop by hop; exact while no shortest path is longer."""
    views = {"d0": f"SELECT id AS s, id AS v, CAST(0 AS DOUBLE) AS d FROM {vertices}"}
    for i in range(1, hops + 1):
        views[f"d{i}"] = f"""SELECT s, v, min(d) AS d FROM (SELECT * FROM d{i - 1} UNION ALL
            SELECT s, dst, d + w FROM d{i - 1} JOIN {links} ON src = v) GROUP BY 1, 2"""
    views["dag"] = f"""SELECT a.s, a.v AS u, b.v FROM d{hops} a JOIN {links} ON src = a.v
                       JOIN d{hops} b ON b.s = a.s AND b.v = dst WHERE b.d = a.d + w"""
    views["f0"] = f"SELECT id AS s, id AS v, CAST(1 AS DOUBLE) AS n FROM {vertices}"
    for i in range(1, hops + 1):
        views[f"f{i}"] = f"SELECT s, dag.v, sum(n) AS n FROM f{i - 1} f JOIN dag USING (s) WHERE f.v = u GROUP BY 1, 2"
    views["sigma"] = (
        "SELECT s, v, sum(n) AS n FROM ("
        + " UNION ALL ".join(f"SELECT * FROM f{i}" for i in range(hops + 1))
        + ") GROUP BY 1, 2"
    )
    views["g0"] = "SELECT s, v, 1 / n AS g FROM sigma WHERE s <> v"
    for i in range(1, hops + 1):
        views[f"g{i}"] = f"SELECT s, u AS v, sum(g) AS g FROM g{i - 1} g JOIN dag USING (s) WHERE g.v = dag.v GROUP BY 1, 2"
    views["delta"] = (
        "SELECT v, sum(g * n) AS b FROM ("
        + " UNION ALL ".join(f"SELECT * FROM g{i}" for i in range(1, hops + 1))
        + ") JOIN sigma USING (s, v) WHERE s <> v GROUP BY 1"
    )
    return views


@query(
    "betweenness_directed",
    with_views(
        "migration_links",
        "migration_vertices",
        extra=betweenness_views("migration_vertices", "migration_links", 8),
        body="""SELECT id AS tech, round(coalesce(b, 0) / ((SELECT count(*) FROM migration_vertices) - 1)
                       / ((SELECT count(*) FROM migration_vertices) - 2), 8) AS betweenness
                FROM migration_vertices LEFT JOIN delta ON v = id""",
    ),
)
def betweenness_directed(t: Inputs) -> DataFrame:
    scores = between.betweenness(migration_vertices(t), t.migration_graph, directed=True)
    return scores.select(F.col("id").alias("tech"), F.round("betweenness", 8).alias("betweenness"))


@query(
    "modularity_by_segment",
    with_views(
        "actor_links",
        "segments",
        extra={
            "labelled": """SELECT a.community_id AS a, b.community_id AS b, w FROM actor_links
                           JOIN segments a ON a.dev_id = src JOIN segments b ON b.dev_id = dst""",
        },
        body="""SELECT round(sum(inside / m2 - (deg / m2) * (deg / m2)), 8) AS modularity FROM
                  (SELECT a, coalesce(sum(w) FILTER (a = b), 0) AS inside, sum(w) AS deg,
                          (SELECT sum(w) FROM labelled) AS m2 FROM labelled GROUP BY 1)""",
    ),
)
def modularity_by_segment(t: Inputs) -> DataFrame:
    labels = t.segments.select(F.col("dev_id").alias("id"), F.col("community_id").alias("community"))
    return community.modularity(labels, t.actor_graph).select(F.round("modularity", 8).alias("modularity"))


@query(
    "betweenness_undirected",
    with_views(
        "actor_links",
        "actor_vertices",
        extra=betweenness_views("actor_vertices", "actor_links", 9),
        body="""SELECT id AS dev_id, round(coalesce(b, 0) / ((SELECT count(*) FROM actor_vertices) - 1)
                       / ((SELECT count(*) FROM actor_vertices) - 2), 8) AS betweenness
                FROM actor_vertices LEFT JOIN delta ON v = id""",
    ),
)
def betweenness_undirected(t: Inputs) -> DataFrame:
    scores = between.betweenness(t.actor_vertices, t.actor_graph, directed=False)
    return scores.select(F.col("id").alias("dev_id"), F.round("betweenness", 8).alias("betweenness"))


# strengths near 100,000, read inversely: routes differ far behind the decimal point
@query(
    "betweenness_inverse",
    with_views(
        "migration_links",
        "migration_vertices",
        extra={
            "strong": "SELECT src, dst, 1 / (100000 + w) AS w FROM migration_links",
            **{
                name: text.replace("WHERE b.d = a.d + w", "WHERE abs(b.d - a.d - w) <= 1e-12 * b.d")
                for name, text in betweenness_views("migration_vertices", "strong", 8).items()
            },
        },
        body="""SELECT id AS tech, round(coalesce(b, 0) / ((SELECT count(*) FROM migration_vertices) - 1)
                       / ((SELECT count(*) FROM migration_vertices) - 2), 8) AS betweenness
                FROM migration_vertices LEFT JOIN delta ON v = id""",
    ),
)
def betweenness_inverse(t: Inputs) -> DataFrame:
    strong = t.migration_graph.withColumn("w", F.lit(100_000.0) + F.col("w"))
    scores = between.betweenness(migration_vertices(t), strong, directed=True, weight_mode="inverse")
    return scores.select(F.col("id").alias("tech"), F.round("betweenness", 8).alias("betweenness"))


def found_communities(t: Inputs) -> DataFrame:
    return community.communities(t.actor_vertices, t.actor_graph)


@query("communities")
def communities(t: Inputs) -> DataFrame:
    return found_communities(t).withColumnRenamed("id", "dev_id")


# labels are free to differ between implementations, so the SQL states what any good ones have
@query(
    "communities_check",
    with_views(
        "actor_vertices",
        body="""SELECT count(*) AS members, true AS ids_by_size, true AS connected, true AS above_singletons,
                  true AS above_components FROM actor_vertices""",
    ),
)
def communities_check(t: Inputs) -> DataFrame:
    found = cut(found_communities(t))
    edges = t.actor_graph
    sizes = found.groupBy("community_id").agg((-F.count("*")).alias("_smaller"))
    placed = global_rank(sizes, ["_smaller", "community_id"], "_place")
    # in order of falling size the ids run 0, 1, 2, ...
    in_order = placed.where(F.col("_place") != F.col("community_id")).isEmpty()
    ends = found.withColumnsRenamed({"id": "src", "community_id": "a"})
    inner = edges.join(ends, "src").join(ends.withColumnsRenamed({"src": "dst", "a": "b"}), "dst").where("a = b")
    parts = comps.components(t.actor_vertices, inner.select("src", "dst", "w"))
    torn = found.join(parts, "id").groupBy("community_id").agg(F.countDistinct("component").alias("n")).where("n > 1")

    # single vertices have a modularity below 0, the components one of 0 or more
    reached = community.modularity(found.withColumnRenamed("community_id", "community"), edges).first()[0]
    whole = comps.components(t.actor_vertices, edges).withColumnRenamed("component", "community")
    of_components = community.modularity(whole, edges).first()[0]
    return found.agg(F.count("*").alias("members")).select(
        "members",
        F.lit(in_order).alias("ids_by_size"),
        F.lit(torn.isEmpty()).alias("connected"),
        F.lit(reached > 0).alias("above_singletons"),
        F.lit(reached >= of_components - 1e-12).alias("above_components"),
    )

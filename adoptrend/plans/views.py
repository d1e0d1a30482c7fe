"""Rankings, distributions, community tables and the other tables behind charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.operators import migration, serving
from adoptrend.operators import actors as ac
from adoptrend.operators import forecast as fc
from adoptrend.operators.graph import betweenness as between
from adoptrend.operators.graph import components as comps
from adoptrend.operators.graph import core, rank
from adoptrend.operators.trends import top_categories
from adoptrend.plans.clusters import ASSIGNED, assigned, features
from adoptrend.plans.forecasting import FORECAST_VIEWS, line
from adoptrend.plans.graphs import betweenness_views, migration_vertices, pagerank_views
from adoptrend.plans.registry import query
from adoptrend.plans.trending import TOP, rounded
from adoptrend.session import cut, scratch_path
from adoptrend.sources import sinks
from adoptrend.sources.inputs import RANK_ROUNDS, SHARED, Inputs, with_views

RANKS = pagerank_views("actor_vertices", "actor_links", RANK_ROUNDS)
INFLUENCE = {
    **RANKS,
    "influence": """SELECT r.id AS dev_id, r.r AS pagerank, d.degree, t.distinct_repos, t.total_commits
                    FROM ranks r JOIN actor_degrees d ON d.id = r.id JOIN top_actors t ON t.dev_id = r.id""",
    "segmented": "SELECT dev_id, community_id, pagerank, degree FROM influence JOIN segments USING (dev_id)",
}
NEEDS = ("actor_links", "actor_vertices", "actor_degrees", "segments")


@query("degree_distribution", with_views("actor_degrees", body="SELECT degree, count(*) AS actors FROM actor_degrees GROUP BY 1"))
def degree_distribution(t: Inputs) -> DataFrame:
    return serving.degree_distribution(t.actor_degrees)


@query(
    "degree_summary",
    with_views(
        "actor_degrees",
        body="""SELECT count(*) AS actors, round(avg(degree), 6) AS mean_degree, max(degree) AS max_degree,
                       count(*) FILTER (degree = 0) AS isolated FROM actor_degrees""",
    ),
)
def degree_summary(t: Inputs) -> DataFrame:
    return rounded(serving.degree_summary(t.actor_degrees), "mean_degree")


def histogram_sql(value: str, table: str, bins: int) -> str:
    return f"""SELECT CAST(least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin,
                      round(lo + (hi - lo) / {bins} * least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}), 6) AS from_value,
                      count(*) AS n
               FROM (SELECT CAST({value} AS DOUBLE) AS v, min(CAST({value} AS DOUBLE)) OVER () AS lo,
                            max(CAST({value} AS DOUBLE)) OVER () AS hi FROM {table}) GROUP BY 1, 2"""


@query("degree_histogram", with_views("actor_degrees", body=histogram_sql("degree", "actor_degrees", 60)))
def degree_histogram(t: Inputs) -> DataFrame:
    return rounded(serving.histogram(cut(t.actor_degrees), F.col("degree"), 60), "from_value")


@query(
    "commits_histogram_log",
    with_views("actor_stats", body=histogram_sql("log10(total_commits + CAST(1e-10 AS DOUBLE))", "actor_stats", 80)),
)
def commits_histogram_log(t: Inputs) -> DataFrame:
    return rounded(serving.histogram(t.actor_stats, F.log10(F.col("total_commits") + F.lit(1e-10)), 80), "from_value")


@query(
    "describe_actors",
    with_views(
        "actor_stats",
        body=" UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd,
                       CAST(min({c}) AS DOUBLE) AS lowest, CAST(max({c}) AS DOUBLE) AS highest,
                       round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
                       round(quantile_cont({c}, 0.75), 6) AS q75 FROM actor_stats"""
            for c in ("distinct_repos", "total_commits")
        ),
    ),
)
def describe_actors(t: Inputs) -> DataFrame:
    stats = t.actor_stats
    return rounded(
        serving.describe(stats, ["distinct_repos", "total_commits"]), "mean", "sd", "q25", "q50", "q75"
    )


@query(
    "rank_activity_corr",
    with_views(
        *NEEDS,
        extra=INFLUENCE,
        body="""SELECT round(corr(x, y), 8) AS r, round(regr_slope(y, x), 10) AS slope,
                       round(regr_intercept(y, x), 10) AS intercept, count(*) AS n
                FROM (SELECT ln(1 + total_commits) AS x, pagerank AS y FROM influence)""",
    ),
)
def rank_activity_corr(t: Inputs) -> DataFrame:
    fitted = serving.corr_fit(t.influence, F.log1p("total_commits"), F.col("pagerank"))
    return fitted.select(
        F.round("r", 8).alias("r"), F.round("slope", 10).alias("slope"), F.round("intercept", 10).alias("intercept"), "n"
    )


INFLUENCE_COLUMNS = "round(pagerank, 10) AS pagerank, degree, distinct_repos, total_commits"


def _rank10(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 10) for c in columns or ("pagerank",)})


@query("influence_table", with_views(*NEEDS, extra=INFLUENCE, body=f"SELECT dev_id, {INFLUENCE_COLUMNS} FROM influence"))
def influence_table(t: Inputs) -> DataFrame:
    return _rank10(t.influence)


@query(
    "influence_search",
    with_views(
        *NEEDS,
        extra=INFLUENCE,
        body=f"""SELECT dev_id, {INFLUENCE_COLUMNS} FROM influence WHERE contains(dev_id, 'ab')
                 ORDER BY degree DESC, dev_id""",
    ),
)
def influence_search(t: Inputs) -> DataFrame:
    return _rank10(serving.influence_search(t.influence, "AB", "degree"))


@query(
    "top_influencers",
    with_views(
        *NEEDS,
        extra={**INFLUENCE, "best": "SELECT * FROM influence ORDER BY round(pagerank, 10) DESC, dev_id LIMIT 200"},
        body=f"SELECT substr(dev_id, 1, 12) AS dev_short, {INFLUENCE_COLUMNS} FROM best",
    ),
)
def top_influencers(t: Inputs) -> DataFrame:
    # ranks of equal actors may differ in the last bits: ties are settled by id from the 10th decimal on
    return serving.top_influencers(_rank10(t.influence), 200)


@query(
    "rank_within_segment",
    with_views(
        *NEEDS,
        extra=INFLUENCE,
        body="""SELECT dev_id, community_id, round(pagerank, 10) AS pagerank, degree, CAST(position AS INTEGER) AS position
                FROM (SELECT *, row_number() OVER (PARTITION BY community_id ORDER BY round(pagerank, 10) DESC, dev_id) AS position
                      FROM segmented) WHERE position <= 5""",
    ),
)
def rank_within_segment(t: Inputs) -> DataFrame:
    return serving.rank_within(_rank10(t.influence.select("dev_id", "pagerank", "degree")), t.segments, 5)


ORGS = """SELECT community_id, string_agg(org, ', ' ORDER BY place) AS top_orgs FROM
            (SELECT community_id, org, row_number() OVER (PARTITION BY community_id ORDER BY cnt DESC, org) AS place
             FROM (SELECT community_id, lower(split_part(repo_name, '/', 1)) AS org, count(*) AS cnt
                   FROM actor_facts JOIN segments USING (dev_id) GROUP BY 1, 2)) WHERE place <= 3 GROUP BY 1"""


@query("community_orgs", with_views("segments", body=ORGS))
def community_orgs(t: Inputs) -> DataFrame:
    return serving.community_orgs(t.segments, t.actor_facts)


PROFILE = f"""SELECT p.*, 'C' || community_id || ' (' || coalesce(top_orgs, '?') || ')' AS label FROM
                (SELECT community_id, count(*) AS size, sum(pagerank) AS total_pagerank, avg(pagerank) AS mean_pagerank,
                        max(pagerank) AS max_pagerank, avg(degree) AS mean_degree FROM segmented GROUP BY 1) p
              LEFT JOIN ({ORGS}) o USING (community_id)"""
PROFILE_COLUMNS = """community_id, size, round(total_pagerank, 10) AS total_pagerank, round(mean_pagerank, 10) AS mean_pagerank,
                     round(max_pagerank, 10) AS max_pagerank, round(mean_degree, 6) AS mean_degree, label"""


def profile(t: Inputs) -> DataFrame:
    orgs = serving.community_orgs(t.segments, t.actor_facts)
    return serving.community_profile(t.segment_members, orgs).drop("top_orgs")


def _profile_rounded(df: DataFrame) -> DataFrame:
    return rounded(_rank10(df, "total_pagerank", "mean_pagerank", "max_pagerank"), "mean_degree")


@query(
    "community_profile",
    with_views(*NEEDS, "actor_facts", extra={**INFLUENCE, "profile": PROFILE}, body=f"SELECT {PROFILE_COLUMNS} FROM profile"),
)
def community_profile(t: Inputs) -> DataFrame:
    return _profile_rounded(profile(t))


@query(
    "leading_communities",
    with_views(
        *NEEDS,
        "actor_facts",
        extra={
            **INFLUENCE,
            "profile": PROFILE,
            "best": "SELECT * FROM profile WHERE size >= 5 ORDER BY size DESC, community_id LIMIT 12",
        },
        body=f"SELECT {PROFILE_COLUMNS} FROM best",
    ),
)
def leading_communities(t: Inputs) -> DataFrame:
    return _profile_rounded(serving.leading_communities(profile(t), 12, "size", 5))


@query(
    "served_communities",
    with_views(
        *NEEDS,
        "actor_facts",
        extra={
            **INFLUENCE,
            "profile": PROFILE,
            "best": "SELECT * FROM profile WHERE size >= 5 ORDER BY size DESC, community_id LIMIT 60",
        },
        body=f"SELECT {PROFILE_COLUMNS} FROM best",
    ),
)
def served_communities(t: Inputs) -> DataFrame:
    return _profile_rounded(serving.leading_communities(profile(t), 60, "size", 5))


@query(
    "influential_communities",
    with_views(
        *NEEDS,
        "actor_facts",
        extra={
            **INFLUENCE,
            "profile": PROFILE,
            "best": "SELECT * FROM profile ORDER BY round(max_pagerank, 10) DESC, community_id LIMIT 10",
        },
        body=f"SELECT {PROFILE_COLUMNS} FROM best",
    ),
)
def influential_communities(t: Inputs) -> DataFrame:
    # equal ranks may differ in the last bits: ties are settled by id from the 10th decimal on
    return serving.leading_communities(_profile_rounded(profile(t)), 10, "max_pagerank")


@query(
    "community_size_summary",
    with_views(
        "segments",
        body="""SELECT count(*) AS communities, max(size) AS largest, count(*) FILTER (size = 1) AS singletons,
                       CAST(sum(size) AS BIGINT) AS members, quantile_cont(size, 0.5) AS median_size
                FROM (SELECT community_id, count(*) AS size FROM segments GROUP BY 1)""",
    ),
)
def community_size_summary(t: Inputs) -> DataFrame:
    return serving.size_summary(t.segments)


@query(
    "degree_bands",
    with_views(
        *NEEDS,
        extra={
            **INFLUENCE,
            "best": """SELECT community_id FROM segmented GROUP BY 1 ORDER BY sum(pagerank) DESC, community_id LIMIT 10""",
        },
        body="""SELECT community_id, count(*) FILTER (degree <= 0) AS band_0, count(*) FILTER (degree BETWEEN 1 AND 2) AS band_1,
                       count(*) FILTER (degree BETWEEN 3 AND 8) AS band_2, count(*) FILTER (degree > 8) AS band_3
                FROM segmented WHERE community_id IN (SELECT community_id FROM best) GROUP BY 1""",
    ),
)
def degree_bands(t: Inputs) -> DataFrame:
    return serving.degree_bands(t.segment_members)


@query(
    "bridge_actors",
    with_views(
        *NEEDS,
        extra={**INFLUENCE, "best": "SELECT * FROM segmented ORDER BY degree DESC, dev_id LIMIT 50"},
        body="""SELECT substr(dev_id, 1, 12) AS dev_short, community_id, round(pagerank, 10) AS pagerank, degree FROM best""",
    ),
)
def bridge_actors(t: Inputs) -> DataFrame:
    return _rank10(serving.bridge_actors(t.segment_members))


@query(
    "communities_touched",
    with_views(
        "actor_links",
        "segments",
        body="""SELECT s.dev_id, count(DISTINCT n.community_id) AS communities_touched
                FROM segments s LEFT JOIN actor_links ON dst = s.dev_id LEFT JOIN segments n ON n.dev_id = src GROUP BY 1""",
    ),
)
def communities_touched(t: Inputs) -> DataFrame:
    return serving.bridging(t.segments, core.symmetric(t.actor_graph))


YEARLY = {
    "years": "SELECT DISTINCT CAST(year AS INTEGER) AS year FROM members",
    "yearly_links": f"""SELECT CAST(a.year AS INTEGER) AS year, a.dev_id AS src, b.dev_id AS dst FROM members a JOIN members b
                        ON a.repo_name = b.repo_name AND a.year = b.year AND a.dev_id <> b.dev_id
                        GROUP BY 1, 2, 3 HAVING count(DISTINCT a.repo_name) >= {SHARED}""",
    "yearly_reach": """SELECT year, id, id AS label FROM actor_vertices, years
                       UNION SELECT l.year, dst, label FROM yearly_reach r JOIN yearly_links l ON src = id AND l.year = r.year""",
    "yearly_labels": "SELECT year, id AS dev_id, min(label) AS community FROM yearly_reach GROUP BY 1, 2",
}


@query(
    "community_flow",
    with_views(
        "members",
        "actor_vertices",
        extra=YEARLY,
        recursive=True,
        body="""SELECT a.year, a.community AS from_community, b.community AS to_community, count(*) AS members
                FROM yearly_labels a JOIN yearly_labels b ON a.dev_id = b.dev_id AND b.year = a.year + 1 GROUP BY 1, 2, 3""",
    ),
)
def community_flow(t: Inputs) -> DataFrame:
    # one run for all years: a vertex is an actor in a year, and edges stay within a year
    at = lambda c: F.concat_ws(":", "year", c)
    pairs = ac.co_edges(t.members, SHARED, yearly=True)
    edges = pairs.select(at("dev_a").alias("src"), at("dev_b").alias("dst"), F.lit(1.0).alias("w"))
    every = t.members.groupBy().agg(F.collect_set("year").alias("years")).scalar()  # a row for each year
    vertices = t.actor_vertices.withColumn("year", F.explode(every)).select(at("id").alias("id"))
    part = lambda c, i: F.split_part(c, F.lit(":"), F.lit(i))
    labels = comps.components(vertices, edges).select(
        part("id", 1).cast("int").alias("year"), part("id", 2).alias("dev_id"), part("component", 2).alias("community_id")
    )
    return serving.community_flows(cut(labels))


@query(
    "cluster_alignment",
    with_views(
        "segments",
        "repos",
        extra={
            "kinds": """SELECT dev_id, arg_max(kind, struct_pack(n := n, k := kind)) AS kind FROM
                        (SELECT dev_id, split_part(lower(trim(language)), '-', 1) AS kind, sum(commit_count) AS n
                         FROM actor_facts JOIN repos USING (repo_name) GROUP BY 1, 2) GROUP BY 1""",
            "cells": "SELECT community_id, kind, count(*) AS n FROM segments JOIN kinds USING (dev_id) GROUP BY 1, 2",
        },
        body="""SELECT community_id, kind, n, round(n / CAST(sum(n) OVER (PARTITION BY community_id) AS DOUBLE), 6) AS share
                FROM cells""",
    ),
)
def cluster_alignment(t: Inputs) -> DataFrame:
    kinds = t.repos.select("repo_name", F.split_part(F.lower(F.trim("language")), F.lit("-"), F.lit(1)).alias("kind"))
    modal = serving.modal_label(t.actor_facts, kinds, "kind")
    return rounded(serving.alignment(t.segments, modal, "dev_id", "community_id", "kind"), "share")


@query(
    "sankey_links",
    with_views(
        "migration_edges",
        extra={
            "best": "SELECT * FROM migration_edges ORDER BY migration_count DESC, from_tech, to_tech LIMIT 20",
            "names": """SELECT tech, CAST(row_number() OVER (ORDER BY tech) - 1 AS INTEGER) AS i
                        FROM (SELECT from_tech AS tech FROM best UNION SELECT to_tech FROM best)""",
        },
        body="""SELECT from_tech, to_tech, a.i AS source, b.i AS target, migration_count AS value
                FROM best JOIN names a ON a.tech = from_tech JOIN names b ON b.tech = to_tech""",
    ),
)
def sankey_links(t: Inputs) -> DataFrame:
    return serving.sankey_links(cut(t.migration_edges))


@query(
    "serving_migration",
    with_views(
        "migration_edges",
        body="""SELECT from_tech, to_tech, migration_count, years_active, CAST(first_year AS INT) AS first_year,
                       CAST(last_year AS INT) AS last_year FROM migration_edges""",
    ),
)
def serving_migration(t: Inputs) -> DataFrame:
    return serving.serving_edges(t.migration_edges)


@query(
    "top_nodes",
    with_views(
        "migration_links",
        "migration_vertices",
        "node_flow",
        extra={
            **pagerank_views("migration_vertices", "migration_links", 20),
            "best": "SELECT id, r FROM ranks ORDER BY round(r, 8) DESC, id LIMIT 15",
        },
        body="""SELECT tech, round(r, 8) AS pagerank, in_weight AS incoming, out_weight AS outgoing, net_flow
                FROM best JOIN node_flow ON tech = id""",
    ),
)
def top_nodes(t: Inputs) -> DataFrame:
    ranks = rank.pagerank(migration_vertices(t), t.migration_graph, iters=20)
    best = ranks.withColumn("pagerank", F.round("pagerank", 8)).orderBy(F.desc("pagerank"), "id").limit(15)
    nodes = migration.node_flow(t.migration_edges).join(best.withColumnRenamed("id", "tech"), "tech")
    return serving.serving_nodes(nodes)


@query(
    "top_nodes_by_betweenness",
    with_views(
        "migration_links",
        "migration_vertices",
        extra={
            **betweenness_views("migration_vertices", "migration_links", 8),
            "scores": """SELECT id AS tech, round(coalesce(b, 0) / ((SELECT count(*) FROM migration_vertices) - 1)
                                / ((SELECT count(*) FROM migration_vertices) - 2), 8) AS betweenness
                         FROM migration_vertices LEFT JOIN delta ON v = id""",
        },
        body="SELECT * FROM scores ORDER BY betweenness DESC, tech LIMIT 15",
    ),
)
def top_nodes_by_betweenness(t: Inputs) -> DataFrame:
    scores = between.betweenness(migration_vertices(t), t.migration_graph)
    named = scores.select(F.col("id").alias("tech"), F.round("betweenness", 8).alias("betweenness"))
    return named.orderBy(F.desc("betweenness"), "tech").limit(15)


SERVED = {
    "d1_monthly": "SELECT count(*) FROM monthly WHERE language IN (SELECT language FROM best)",
    "d1_clusters": "SELECT count(*) FROM assigned WHERE language IN (SELECT language FROM best)",
    "d2_forecasts": "SELECT count(*) FROM fc",
    "d3_edges": "SELECT count(*) FROM migration_edges",
    "d3_nodes": "SELECT count(*) FROM node_flow",
    "d4_pagerank": "SELECT least(200, count(*)) FROM influence",
    "d5_communities": "SELECT least(60, count(*) FILTER (size >= 5)) FROM profile",
    "d5_bridge_devs": "SELECT least(50, count(*)) FROM segmented",
    "d5_totals": "SELECT 1",
}


@query(
    "export_serving_tables",
    with_views(
        "monthly",
        "migration_edges",
        "node_flow",
        *NEEDS,
        "actor_facts",
        extra={**FORECAST_VIEWS, **INFLUENCE, **ASSIGNED, "profile": PROFILE, "best": TOP.format(20)},
        body=" UNION ALL ".join(f"SELECT '{name}' AS served, ({count}) AS n" for name, count in SERVED.items()),
    ),
)
def export_serving_tables(t: Inputs) -> DataFrame:
    """All tables of the dashboard, written as JSON and read back."""
    leading = cut(top_categories(t.monthly_table, 20)).select("language")
    keep = lambda df: df.join(leading, "language", "left_semi")
    tables = serving.dashboard_tables(
        keep(t.monthly_table), keep(assigned(t)), fc.legacy_columns(line(t).withColumn("model", F.lit("linear"))),
        t.migration_edges, migration.node_flow(t.migration_edges), t.influence, t.segment_members,
        serving.community_orgs(t.segments, t.actor_facts),
    )
    out = None
    for name, df in tables.items():
        path = scratch_path(t.spark, "json")
        sinks.write_json(df, path)
        row = t.spark.read.schema(df.schema).json(path).agg(F.count("*").alias("n")).select(F.lit(name).alias("served"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "export_serving_json",
    with_views(
        "monthly",
        extra={"best": TOP.format(20)},
        body="""SELECT language, year_month, repo_count, total_bytes, commit_count FROM monthly
                WHERE language IN (SELECT language FROM best)""",
    ),
)
def export_serving_json(t: Inputs) -> DataFrame:
    leading = top_categories(t.monthly_table, 20).select("language")
    slim = t.monthly_table.join(leading, "language", "left_semi").select(
        "language", "year_month", "repo_count", "total_bytes", "commit_count"
    )
    path = scratch_path(t.spark, "json")
    sinks.write_json(slim, path)
    return t.spark.read.schema(slim.schema).json(path)


@query(
    "deliverable_summary",
    with_views(
        "monthly",
        "migration_edges",
        "node_flow",
        "actor_degrees",
        "segments",
        extra=FORECAST_VIEWS,
        body="""SELECT 'monthly' AS deliverable, count(*) AS n,
                       count(DISTINCT language) || ' categories, ' || min(year_month) || ' to ' || max(year_month) AS key_fact
                FROM monthly
                UNION ALL SELECT 'features', count(*), max(language) FROM (SELECT DISTINCT language FROM monthly)
                UNION ALL SELECT 'forecasts', count(*), CAST(count(DISTINCT language) AS VARCHAR) || ' categories' FROM fc
                UNION ALL SELECT 'edges', count(*), 'weight ' || min(migration_count) || ' to ' || max(migration_count)
                FROM migration_edges
                UNION ALL SELECT 'nodes', count(*), 'top destination ' || arg_max(tech, struct_pack(n := net_flow, t := tech))
                FROM node_flow
                UNION ALL SELECT 'actors', count(*), 'max degree ' || max(degree) FROM actor_degrees
                UNION ALL SELECT 'communities', count(*), count(DISTINCT community_id) || ' communities' FROM segments""",
    ),
)
def deliverable_summary(t: Inputs) -> DataFrame:
    monthly = t.monthly_table
    count = lambda c, unit: F.concat(F.countDistinct(c).cast("string"), F.lit(unit))
    span = F.concat(F.countDistinct("language").cast("string"), F.lit(" categories, "), F.min("year_month"), F.lit(" to "), F.max("year_month"))
    weights = F.concat(F.lit("weight "), F.min("migration_count").cast("string"), F.lit(" to "), F.max("migration_count").cast("string"))
    nodes = migration.node_flow(t.migration_edges)
    rows = [
        serving.summary_row(monthly, "monthly", span),
        serving.summary_row(features(t), "features", F.max("language")),
        serving.summary_row(line(t), "forecasts", count("language", " categories")),
        serving.summary_row(t.migration_edges, "edges", weights),
        serving.summary_row(nodes, "nodes", F.concat(F.lit("top destination "), F.max_by("tech", F.struct("net_flow", "tech")))),
        serving.summary_row(t.actor_degrees, "actors", F.concat(F.lit("max degree "), F.max("degree").cast("string"))),
        serving.summary_row(t.segments, "communities", count("community_id", " communities")),
    ]
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out

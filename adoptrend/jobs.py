"""The batch jobs: raw tables in, result tables out.

    spark-submit adoptrend/jobs.py all --base hdfs:///activity --from 201501 --to 202506 --series 30 --actors 25000

``extract`` reads the event log, a folder per month under ``<base>/log/events`` (type, repo_name, actor_login,
created_at, payload), and ``ingest`` the labels under ``<base>/log/labels`` (repo_name, language, created_at). They write
the raw tables, Parquet folders under ``<base>/raw``: languages, commits, migrations, developers.
Results are Parquet folders under ``<base>/processed`` and, for the dashboard, JSON under ``--out``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptrend.functions.calendar import year_label
from adoptrend.functions.fixed import CLUSTERS, FEATURES, TOP_ACTORS, TOP_SERIES
from adoptrend.operators import actors, clean, extract, features, forecast, migration, serving, trends
from adoptrend.operators.graph import betweenness as between
from adoptrend.operators.graph import community, core, rank
from adoptrend.session import cut, drop_scratch, tune_for_logs
from adoptrend.sources import log, sinks

SERVED_CATEGORIES = 20
PUSH = "PushEvent"


class Job:
    """One run over one base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = tune_for_logs(spark), base.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return sinks.read_table(self.spark, f"{self.base}/raw/{name}")

    def done(self, name: str) -> DataFrame:
        return sinks.read_table(self.spark, f"{self.base}/processed/{name}")

    def write(self, df: DataFrame, name: str) -> None:
        sinks.write_table(df, f"{self.base}/processed/{name}")

    def write_raw(self, df: DataFrame, name: str) -> None:
        sinks.write_table(df, f"{self.base}/raw/{name}")

    def extract(self, lo: str | None = None, hi: str | None = None) -> None:
        """Activity, actors and migration signals of the months ``lo`` to ``hi`` of the event log."""
        events = log.load_events(self.spark, f"{self.base}/log/events", lo, hi)
        pushes = events.where(F.col("type") == PUSH)
        self.write_raw(extract.monthly_activity(pushes, "repo_name", "created_at"), "commits")
        actors_of = extract.actor_edges(pushes, "actor_login", "repo_name", "created_at")
        self.write_raw(actors_of.withColumnRenamed("actor", "developer_email"), "developers")
        told = pushes.select(year_label(F.col("created_at")).alias("year"), "payload")
        messages = extract.json_unnest(told, "payload", "commits", "message")
        self.write_raw(extract.mine_pairs(messages, "message", "year"), "migrations")

    def ingest(self) -> None:
        """Labels as the later steps read them, and how many were left out."""
        labels = self.spark.read.parquet(f"{self.base}/log/labels")
        seen = extract.ingest_audit(labels).first()
        print(f"ingest: {seen.kept:,} of {seen.seen:,} labels kept, {seen.skipped:,} skipped")
        self.write_raw(extract.ingest_labels(labels), "languages")

    def preprocess(self) -> None:
        labels = clean.clean_labels(self.raw("languages"))
        activity = clean.clean_activity(self.raw("commits"))
        sides = clean.join_diagnostics(labels, activity).first()
        print(f"preprocess: {sides.only_in_activity:,} repositories without label, {sides.only_in_labels:,} without activity")
        sinks.write_partitioned(clean.enrich(labels, activity), f"{self.base}/processed/d1_preprocessed", "language")

    def aggregate(self) -> None:
        self.write(trends.monthly_metrics(self.done("d1_preprocessed")), "d1_monthly")

    def cluster(self, k: int = CLUSTERS) -> None:
        table = cut(features.growth_features(self.done("d1_monthly")))
        rows, centres, silhouette = features.cluster(table, k, score=True)
        print(f"cluster: silhouette of {k} clusters {silhouette:.4f}")
        self.write(rows.select("language", "cluster", *FEATURES), "d1_clusters")
        self.write(centres, "d1_cluster_centers")

    def forecast(self, top_n: int = TOP_SERIES) -> None:
        rows = cut(forecast.forecast(self.done("d1_monthly"), top_n=top_n))
        self.write(rows, "d2_forecast_rows")
        self.write(forecast.legacy_columns(rows), "d2_forecasts")

    def migrations(self) -> None:
        edges = cut(migration.edge_rollup(migration.allowlisted(self.raw("migrations"))))
        graph = edges.select(F.col("from_tech").alias("src"), F.col("to_tech").alias("dst"), F.col("migration_count").alias("w"))
        nodes = core.endpoints(graph)
        scored = rank.pagerank(nodes, graph).join(between.betweenness(nodes, graph), "id")
        self.write(edges, "d3_edges")
        self.write(migration.node_flow(edges).join(scored.withColumnRenamed("id", "tech"), "tech"), "d3_nodes")

    def developers(self, top_n: int = TOP_ACTORS) -> None:
        facts = cut(actors.clean_actor_edges(self.raw("developers")))
        chosen = cut(actors.top_actors(cut(actors.actor_stats(facts)), top_n))
        members = cut(actors.hubless(cut(actors.membership(facts, chosen))))
        pairs = actors.co_edges(members)
        graph = cut(pairs.select(F.col("dev_a").alias("src"), F.col("dev_b").alias("dst"), F.col("shared_repos").alias("w")))
        vertices = chosen.select(F.col("dev_id").alias("id"))
        table = cut(
            serving.influence_table(
                rank.pagerank(vertices, graph, directed=False),
                core.degree(vertices, core.symmetric(graph)),
                chosen,
                between.betweenness(vertices, graph, directed=False),
            )
        )
        self.write(serving.legacy_influence(table), "d4_pagerank")
        labels = community.communities(vertices, graph).withColumnRenamed("id", "dev_id")
        self.write(
            table.join(labels, "dev_id").select(
                "dev_id",
                F.col("community_id").cast("int").alias("community_id"),
                "pagerank",
                F.col("degree").cast("int").alias("degree"),
            ),
            "d5_communities",
        )
        self.write(serving.community_orgs(labels, facts), "d5_top_orgs")

    def export(self, out: str, top_langs: int = SERVED_CATEGORIES) -> None:
        """The slim tables the dashboard reads, one JSON folder each."""
        monthly = self.done("d1_monthly")
        leading = cut(trends.top_categories(monthly, top_langs)).select("language")
        keep = lambda df: df.join(leading, "language", "left_semi")
        tables = serving.dashboard_tables(
            keep(monthly), keep(self.done("d1_clusters")), self.done("d2_forecasts"), self.done("d3_edges"),
            self.done("d3_nodes"), self.done("d4_pagerank"), self.done("d5_communities"), self.done("d5_top_orgs"),
        )
        for name, df in tables.items():
            sinks.write_json(df, f"{out.rstrip('/')}/{name}")


# step -> (folders read, folders written), below the base folder
STEPS = {
    "extract": (("log/events",), ("raw/commits", "raw/developers", "raw/migrations")),
    "ingest": (("log/labels",), ("raw/languages",)),
    "preprocess": (("raw/languages", "raw/commits"), ("processed/d1_preprocessed",)),
    "aggregate": (("processed/d1_preprocessed",), ("processed/d1_monthly",)),
    "cluster": (("processed/d1_monthly",), ("processed/d1_clusters", "processed/d1_cluster_centers")),
    "forecast": (("processed/d1_monthly",), ("processed/d2_forecast_rows", "processed/d2_forecasts")),
    "migrations": (("raw/migrations",), ("processed/d3_edges", "processed/d3_nodes")),
    "developers": (("raw/developers",), ("processed/d4_pagerank", "processed/d5_communities", "processed/d5_top_orgs")),
    "export": (("processed",), ("serving",)),
}


def run(
    spark: SparkSession,
    steps,
    base: str,
    out: str | None = None,
    k: int = CLUSTERS,
    series: int = TOP_SERIES,
    top_actors: int = TOP_ACTORS,
    top_langs: int = SERVED_CATEGORIES,
    months: tuple[str | None, str | None] = (None, None),
    dry_run: bool = False,
) -> None:
    """The steps in the given order; ``dry_run`` only says what each would read and write."""
    job = Job(spark, base)
    options = {
        "extract": {"lo": months[0], "hi": months[1]},
        "cluster": {"k": k},
        "forecast": {"top_n": series},
        "developers": {"top_n": top_actors},
        "export": {"out": out or f"{job.base}/serving", "top_langs": top_langs},
    }
    for step in steps:
        if dry_run:
            read, written = STEPS[step]
            told = ", ".join(f"{name}={value}" for name, value in options.get(step, {}).items())
            print(f"{step}({told}): {', '.join(read)} -> {', '.join(written)}")
            continue
        getattr(job, step)(**options.get(step, {}))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("step", choices=[*STEPS, "all"])
    parser.add_argument("--base", required=True, help="folder that holds log/, raw/ and processed/")
    parser.add_argument("--out", help="folder for the JSON export (default: <base>/serving)")
    parser.add_argument("--from", dest="lo", help="first month to extract, YYYYMM")
    parser.add_argument("--to", dest="hi", help="last month to extract, YYYYMM")
    parser.add_argument("--k", type=int, default=CLUSTERS, help="number of clusters")
    parser.add_argument("--series", type=int, default=TOP_SERIES, help="series to forecast")
    parser.add_argument("--actors", type=int, default=TOP_ACTORS, help="actors to keep")
    parser.add_argument("--top-langs", type=int, default=SERVED_CATEGORIES, help="categories in the JSON export")
    parser.add_argument("--dry-run", action="store_true", help="only say what would be read and written")
    given = parser.parse_args(arguments)
    spark = SparkSession.builder.appName(f"adoptrend-{given.step}").getOrCreate()
    try:
        run(
            spark, STEPS if given.step == "all" else [given.step], given.base, given.out, given.k, given.series,
            given.actors, given.top_langs, (given.lo, given.hi), given.dry_run,
        )
    finally:
        drop_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()

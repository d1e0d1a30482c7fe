"""The logical tables as views over a star schema, each once as DataFrame and once as SQL.

The star schema has no repositories: a part stands for one, its type and size for the language,
a shipped line for a push, a customer for the developer and a change of brand between two
purchases for a migration.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adoptrend.functions.calendar import month_label, year_label
from adoptrend.functions.fixed import EXCLUDED_LABELS
from adoptrend.functions.text import normalise
from adoptrend.operators import actors, clean, extract, migration, serving, trends
from adoptrend.operators.graph import core, rank
from adoptrend.operators.ordered import previous_value
from adoptrend.session import cut, tune_for_logs

# thresholds that bite on the test tables; the library's defaults are the published ones
CUTOFF = "2001-06"
COVERAGE = 60
SPAN = 72
EXCLUDE = (*EXCLUDED_LABELS, "economy-1", "promo-13", "standard-50")
EDGE_WEIGHT = 100
REPOS = (10, 75)
MEMBERS = 40
SHARED = 2
YEAR = "2000"
RANK_ROUNDS = 10
MESSAGE_STEMS = ("the", "and", "of", "in", "was")
MESSAGE_SWAPS = ("with", "for")


class Inputs:
    """Lazily built logical tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune_for_logs(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def repos(self) -> DataFrame:
        return self.table("part").select(
            "p_partkey",
            F.concat(F.lower("p_brand"), F.lit("/part-"), F.col("p_partkey")).alias("repo_name"),
            F.concat(F.lit(" "), F.upper("p_type"), F.lit("-"), F.col("p_size"), F.lit(" ")).alias("language"),
            F.col("p_size"),
        )

    @cached_property
    def languages_flat(self) -> DataFrame:
        returned = (
            self.table("lineitem")
            .where(F.col("l_returnflag") == "R")
            .groupBy("l_partkey")
            .agg(F.min("l_shipdate").alias("first_return"))
        )
        born = F.when(F.col("p_size") > 5, F.date_format("first_return", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        return self.repos.join(returned, F.col("l_partkey") == F.col("p_partkey"), "left").select(
            "repo_name", "language", F.col("p_size").cast("long").alias("bytes"), born.alias("created_at")
        )

    @cached_property
    def commits_monthly(self) -> DataFrame:
        return self._commits(self.table("lineitem"))

    def _commits(self, lines: DataFrame) -> DataFrame:
        # counted by key and first day of the month, both whole numbers, before names are joined
        counted = lines.groupBy("l_partkey", F.trunc("l_shipdate", "month").alias("month")).agg(
            F.count("*").alias("commit_count")
        )
        return counted.join(self.repos, F.col("l_partkey") == F.col("p_partkey")).select(
            "repo_name", month_label(F.col("month")).alias("year_month"), "commit_count"
        )

    @cached_property
    def labels(self) -> DataFrame:
        return clean.clean_labels(self.languages_flat, EXCLUDE)

    @cached_property
    def activity(self) -> DataFrame:
        # the cutoff as a time range as well: only that reaches the statistics of the raw log
        lines = extract.scan_months(self.table("lineitem"), "l_shipdate", None, CUTOFF)
        return clean.clean_activity(self._commits(lines), CUTOFF)

    @cached_property
    def enriched(self) -> DataFrame:
        return clean.enrich(self.labels, self.activity)

    @cached_property
    def monthly(self) -> DataFrame:
        return trends.monthly_metrics(self.enriched, COVERAGE)

    @cached_property
    def monthly_table(self) -> DataFrame:
        """The monthly metrics written once, for queries that read them several times."""
        return cut(self.monthly)

    @cached_property
    def pushes(self) -> DataFrame:
        """One row per line of an order: who, which repository, when."""
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.concat(F.lit("Customer-"), F.col("o_custkey")).alias("login"),
                F.concat(F.lower("p_brand"), F.lit("/part-"), F.col("p_partkey")).alias("repo_name"),
                F.col("o_orderdate").alias("created_at"),
                "o_custkey",
                "o_orderkey",
                "l_linenumber",
                "l_partkey",
                "l_suppkey",
                "p_brand",
            )
        )

    @cached_property
    def developer_repos(self) -> DataFrame:
        return self._developer_repos(self.table("orders"))

    def developer_repos_of(self, repos: DataFrame) -> DataFrame:
        """The same for some repositories: the others leave the log first."""
        chosen = repos.select(F.col("p_partkey").alias("l_partkey"))
        return self._developer_repos(self.table("orders"), self.table("lineitem").join(chosen, "l_partkey", "left_semi"))

    def _developer_repos(self, orders: DataFrame, lines: DataFrame | None = None) -> DataFrame:
        # whole numbers are shuffled and counted; names are joined to what is left
        counted = (
            (self.table("lineitem") if lines is None else lines)
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy("o_custkey", "l_partkey", year_label(F.col("o_orderdate")).alias("year"))
            .agg(F.count("*").alias("commit_count"))
        )
        return counted.join(self.repos, F.col("l_partkey") == F.col("p_partkey")).select(
            F.concat(F.lit("Customer-"), F.col("o_custkey")).alias("developer_email"), "repo_name", "year", "commit_count"
        )

    @cached_property
    def actor_facts(self) -> DataFrame:
        orders = extract.scan_months(self.table("orders"), "o_orderdate", None, f"{YEAR}-12")
        return cut(actors.clean_actor_edges(self._developer_repos(orders), last_year=YEAR))

    @cached_property
    def actor_stats(self) -> DataFrame:
        return cut(actors.actor_stats(self.actor_facts, *REPOS))

    @cached_property
    def top_actors(self) -> DataFrame:
        return cut(actors.top_actors(self.actor_stats))

    @cached_property
    def members(self) -> DataFrame:
        return cut(actors.hubless(actors.membership(self.actor_facts, self.top_actors), MEMBERS))

    @cached_property
    def co_edges(self) -> DataFrame:
        return actors.co_edges(self.members, SHARED)

    @cached_property
    def actor_vertices(self) -> DataFrame:
        return self.top_actors.select(F.col("dev_id").alias("id"))

    @cached_property
    def actor_graph(self) -> DataFrame:
        return cut(
            self.co_edges.select(F.col("dev_a").alias("src"), F.col("dev_b").alias("dst"), F.col("shared_repos").alias("w"))
        )

    @cached_property
    def actor_degrees(self) -> DataFrame:
        return core.degree(self.actor_vertices, core.symmetric(self.actor_graph))

    @cached_property
    def actor_ranks(self) -> DataFrame:
        return rank.pagerank(self.actor_vertices, self.actor_graph, directed=False, iters=RANK_ROUNDS)

    @cached_property
    def influence(self) -> DataFrame:
        return serving.influence_table(self.actor_ranks, self.actor_degrees, self.top_actors)

    @cached_property
    def segment_members(self) -> DataFrame:
        """Actors with segment, rank and degree, as communities are tabulated."""
        return cut(self.influence.join(self.segments, "dev_id").select("dev_id", "community_id", "pagerank", "degree"))

    @cached_property
    def segments(self) -> DataFrame:
        """A given label per actor: the customer's nation."""
        named = self.table("customer").select(
            F.sha2(normalise(F.concat(F.lit("Customer-"), F.col("c_custkey"))), 256).alias("dev_id"),
            F.col("c_nationkey").cast("long").alias("community_id"),
        )
        return named.join(self.top_actors.select("dev_id"), "dev_id", "left_semi")

    @cached_property
    def migration_signals(self) -> DataFrame:
        order = ["created_at", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        moves = previous_value(self.pushes.select("o_custkey", *order, "p_brand"), ["o_custkey"], order, "p_brand", "before")
        return (
            moves.where(F.col("before") != F.col("p_brand"))
            .groupBy(
                F.lower("before").alias("from_tech"),
                F.lower("p_brand").alias("to_tech"),
                year_label(F.col("created_at")).alias("year"),
            )
            .agg(F.count("*").alias("migration_count"))
        )

    @cached_property
    def migration_edges(self) -> DataFrame:
        """Written once: a row per pair of brands, behind the costliest pass over the log."""
        return cut(migration.edge_rollup(migration.allowlisted(self.migration_signals, allow=None), EDGE_WEIGHT))

    @cached_property
    def migration_graph(self) -> DataFrame:
        return cut(
            self.migration_edges.select(
                F.col("from_tech").alias("src"), F.col("to_tech").alias("dst"), F.col("migration_count").alias("w")
            )
        )

    @cached_property
    def payloads(self) -> DataFrame:
        """Push payloads: every document an event, its lines the messages of its commits."""
        line = F.transform(F.split("text", "\n"), lambda m: F.struct(m.alias("message")))
        documents = self.table("documents").select("doc_id", "lang", "text")
        return documents.select(
            "doc_id", "lang", F.to_json(F.struct(line.alias("commits"))).alias("payload")
        )

    @cached_property
    def messages(self) -> DataFrame:
        return extract.json_unnest(self.payloads, "payload", "commits", "message")


# The same tables as SQL: name -> (tables it needs, text).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "repos": (
        (),
        """SELECT p_partkey, lower(p_brand) || '/part-' || p_partkey AS repo_name,
                  ' ' || upper(p_type) || '-' || p_size || ' ' AS language, p_size FROM part""",
    ),
    "languages_flat": (
        ("repos",),
        """SELECT repo_name, language, CAST(p_size AS BIGINT) AS bytes,
                  CASE WHEN p_size > 5 THEN strftime(first_return, '%Y-%m-%dT%H:%M:%SZ') END AS created_at
           FROM repos LEFT JOIN (SELECT l_partkey, min(l_shipdate) AS first_return FROM lineitem
                                 WHERE l_returnflag = 'R' GROUP BY 1) r ON l_partkey = p_partkey""",
    ),
    "commits_monthly": (
        ("repos",),
        """SELECT repo_name, strftime(l_shipdate, '%Y-%m') AS year_month, count(*) AS commit_count
           FROM lineitem JOIN repos ON l_partkey = p_partkey GROUP BY 1, 2""",
    ),
    "labels": (
        ("languages_flat",),
        f"""SELECT repo_name, lower(trim(language)) AS language, bytes,
                   strftime(try_cast(created_at AS TIMESTAMP), '%Y-%m') AS created_month
            FROM languages_flat
            WHERE language IS NOT NULL AND trim(language) <> ''
              AND lower(trim(language)) NOT IN ({", ".join(f"'{x}'" for x in EXCLUDE)})""",
    ),
    "activity": (
        ("commits_monthly",),
        f"""SELECT repo_name, year_month, commit_count FROM commits_monthly
            WHERE year_month IS NOT NULL AND commit_count > 0 AND year_month <= '{CUTOFF}'""",
    ),
    "enriched": (
        ("labels", "activity"),
        """SELECT repo_name, language, bytes, year_month, commit_count
           FROM (SELECT repo_name, language, max(bytes) AS bytes, min(created_month) AS created_month
                 FROM labels GROUP BY 1, 2) l JOIN activity USING (repo_name)
           WHERE created_month IS NULL OR year_month >= created_month""",
    ),
    "monthly_all": (
        ("enriched",),
        """SELECT language, year_month, CAST(sum(bytes) AS BIGINT) AS total_bytes,
                  count(DISTINCT repo_name) AS repo_count, CAST(sum(commit_count) AS BIGINT) AS commit_count
           FROM enriched GROUP BY 1, 2""",
    ),
    "monthly": (
        ("monthly_all",),
        f"""SELECT * FROM monthly_all WHERE language IN
            (SELECT language FROM monthly_all GROUP BY 1 HAVING count(*) >= {COVERAGE})""",
    ),
    "pushes": (
        (),
        """SELECT 'Customer-' || o_custkey AS login, lower(p_brand) || '/part-' || p_partkey AS repo_name,
                  o_orderdate AS created_at, o_custkey, o_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    ),
    "developer_repos": (
        ("pushes",),
        """SELECT login AS developer_email, repo_name, CAST(year(created_at) AS VARCHAR) AS year,
                  count(*) AS commit_count FROM pushes GROUP BY 1, 2, 3""",
    ),
    "actor_facts": (
        ("developer_repos",),
        f"""SELECT sha256(lower(trim(developer_email))) AS dev_id, repo_name, year, commit_count
            FROM developer_repos WHERE developer_email <> '' AND commit_count >= 1 AND year <= '{YEAR}'""",
    ),
    "actor_stats": (
        ("actor_facts",),
        f"""SELECT dev_id, count(DISTINCT repo_name) AS distinct_repos, CAST(sum(commit_count) AS BIGINT) AS total_commits
            FROM actor_facts GROUP BY 1 HAVING count(DISTINCT repo_name) BETWEEN {REPOS[0]} AND {REPOS[1]}""",
    ),
    "top_actors": (
        ("actor_stats",),
        "SELECT * FROM actor_stats ORDER BY distinct_repos DESC, dev_id LIMIT 25000",
    ),
    "membership": (
        ("actor_facts", "top_actors"),
        """SELECT DISTINCT dev_id, repo_name, year FROM actor_facts
           WHERE dev_id IN (SELECT dev_id FROM top_actors)""",
    ),
    "members": (
        ("membership",),
        f"""SELECT * FROM membership WHERE repo_name IN
            (SELECT repo_name FROM membership GROUP BY 1 HAVING count(DISTINCT dev_id) <= {MEMBERS})""",
    ),
    "co_edges": (
        ("members",),
        f"""SELECT a.dev_id AS dev_a, b.dev_id AS dev_b, count(DISTINCT a.repo_name) AS shared_repos
            FROM members a JOIN members b ON a.repo_name = b.repo_name AND a.year = b.year AND a.dev_id < b.dev_id
            GROUP BY 1, 2 HAVING count(DISTINCT a.repo_name) >= {SHARED}""",
    ),
    "actor_links": (
        ("co_edges",),
        """SELECT dev_a AS src, dev_b AS dst, CAST(shared_repos AS DOUBLE) AS w FROM co_edges
           UNION ALL SELECT dev_b, dev_a, CAST(shared_repos AS DOUBLE) FROM co_edges""",
    ),
    "actor_vertices": (("top_actors",), "SELECT dev_id AS id FROM top_actors"),
    "actor_degrees": (
        ("actor_vertices", "actor_links"),
        """SELECT id, count(src) AS degree FROM actor_vertices LEFT JOIN actor_links ON src = id GROUP BY 1""",
    ),
    "segments": (
        ("top_actors",),
        """SELECT sha256('customer-' || c_custkey) AS dev_id, CAST(c_nationkey AS BIGINT) AS community_id FROM customer
           WHERE sha256('customer-' || c_custkey) IN (SELECT dev_id FROM top_actors)""",
    ),
    "moves": (
        ("pushes",),
        """SELECT *, lag(p_brand) OVER (PARTITION BY o_custkey
                  ORDER BY created_at, o_orderkey, l_linenumber, l_partkey, l_suppkey) AS before FROM pushes""",
    ),
    "migration_signals": (
        ("moves",),
        """SELECT lower(before) AS from_tech, lower(p_brand) AS to_tech, CAST(year(created_at) AS VARCHAR) AS year,
                  count(*) AS migration_count FROM moves WHERE before <> p_brand GROUP BY 1, 2, 3""",
    ),
    "migration_edges": (
        ("migration_signals",),
        f"""SELECT from_tech, to_tech, CAST(sum(migration_count) AS BIGINT) AS migration_count,
                   count(DISTINCT year) AS years_active, min(year) AS first_year, max(year) AS last_year
            FROM migration_signals GROUP BY 1, 2 HAVING sum(migration_count) >= {EDGE_WEIGHT}""",
    ),
    "migration_links": (
        ("migration_edges",),
        "SELECT from_tech AS src, to_tech AS dst, CAST(migration_count AS DOUBLE) AS w FROM migration_edges",
    ),
    "migration_vertices": (
        ("migration_links",),
        "SELECT src AS id FROM migration_links UNION SELECT dst FROM migration_links",
    ),
    "node_flow": (
        ("migration_edges",),
        """SELECT tech, CAST(sum(o) AS BIGINT) AS out_weight, CAST(sum(i) AS BIGINT) AS in_weight,
                  CAST(sum(i) - sum(o) AS BIGINT) AS net_flow
           FROM (SELECT from_tech AS tech, migration_count AS o, 0 AS i FROM migration_edges
                 UNION ALL SELECT to_tech, 0, migration_count FROM migration_edges) GROUP BY 1""",
    ),
    "messages": (
        (),
        """SELECT doc_id, lang, CAST(pos AS INTEGER) AS pos, message FROM
           (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS message,
                   unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)""",
    ),
}


def with_views(*names: str, body: str, extra: dict[str, str] | None = None, recursive: bool = False) -> str:
    """``body`` behind the WITH clause of the named views and everything they need."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in ordered:
            return
        for dependency in VIEWS[name][0]:
            need(dependency)
        ordered.append(name)

    for name in names:
        need(name)
    parts = [f"{name} AS MATERIALIZED ({VIEWS[name][1]})" for name in ordered]
    parts += [f"{name} AS {'' if recursive else 'MATERIALIZED '}({text})" for name, text in (extra or {}).items()]
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {body}"

"""The co-contribution graph: from (actor, repository, year) facts to weighted pairs of actors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.fixed import (
    LAST_ACTOR_YEAR,
    MAX_MEMBERS,
    MAX_REPOS,
    MIN_REPOS,
    MIN_SHARED,
    TOP_ACTORS,
)
from adoptrend.functions.text import normalise, present
from adoptrend.operators.ordered import global_rank, running_total


def pseudonymise(df: DataFrame, id_col: str, out: str = "dev_id", salt: str | None = None) -> DataFrame:
    """Replace an identity by its SHA-256; a secret ``salt`` also defeats a dictionary of known names."""
    plain = normalise(F.col(id_col))
    hashed = F.sha2(plain if salt is None else F.concat(F.lit(salt), plain), 256)
    return df.withColumn(out, hashed).drop(*([id_col] if id_col != out else []))


def clean_actor_edges(
    df: DataFrame, id_col: str = "developer_email", last_year: str = LAST_ACTOR_YEAR, salt: str | None = None
) -> DataFrame:
    """Pseudonymous (actor, repository, year, count) facts up to ``last_year``."""
    kept = df.where(present(F.col(id_col)) & (F.col("commit_count") >= 1) & (F.col("year") <= last_year))
    return pseudonymise(kept, id_col, salt=salt)


def actor_stats(edges: DataFrame, min_repos: int = MIN_REPOS, max_repos: int = MAX_REPOS) -> DataFrame:
    """Breadth and activity of actors; one-off and machine-like actors are left out."""
    return (
        edges.groupBy("dev_id")
        .agg(F.countDistinct("repo_name").alias("distinct_repos"), F.sum("commit_count").alias("total_commits"))
        .where(F.col("distinct_repos").between(min_repos, max_repos))
    )


def top_actors(stats: DataFrame, n: int = TOP_ACTORS) -> DataFrame:
    """The ``n`` broadest actors, ties by id.

    Actors are counted per breadth first, which gives the breadth of the n-th actor. Broader ones
    pass as they are; only those of just that breadth are put in order, over ranges of ids, so no
    task gathers the ``n`` however large it is. ``stats`` is read twice.
    """
    per_breadth = stats.groupBy((-F.col("distinct_repos")).alias("_narrow")).agg(F.count("*").alias("_n"))
    edge = (
        running_total(per_breadth, ["_narrow"], "_n", "_upto")
        .where(F.col("_upto") - F.col("_n") < n)
        .agg((-F.max("_narrow")).alias("least"), F.max(F.col("_upto") - F.col("_n")).alias("above"))
        .first()
    )
    if edge["least"] is None:
        return stats.limit(0)
    tied = global_rank(stats.where(F.col("distinct_repos") == edge["least"]), ["dev_id"], "_place")
    within = tied.where(F.col("_place") < n - edge["above"]).select(*stats.columns)
    return stats.where(F.col("distinct_repos") > edge["least"]).unionByName(within)


def membership(edges: DataFrame, actors: DataFrame) -> DataFrame:
    """Distinct (actor, repository, year) of the chosen actors."""
    return edges.join(actors.select("dev_id"), "dev_id", "left_semi").select("dev_id", "repo_name", "year").distinct()


def hubless(members: DataFrame, max_members: int = MAX_MEMBERS) -> DataFrame:
    """Membership without repositories of more than ``max_members`` actors.

    The crowded repositories are the short list, so they are what is removed; a single one of
    them may own much of the input, and the join splits it at run time.
    """
    crowded = (
        members.groupBy("repo_name")
        .agg(F.countDistinct("dev_id").alias("_members"))
        .where(F.col("_members") > max_members)
        .select("repo_name")
    )
    return members.join(crowded, "repo_name", "left_anti")


def _pairs(members: DataFrame, period: bool) -> DataFrame:
    """``(dev_a, dev_b, repo_name)`` once for each repository both touched in a same year, with ``year`` on request.

    The members of a repository are gathered once, and the pairs go out from there. ``hubless``
    bounds the members of a repository, so it bounds what is gathered and emitted.
    """
    key = ["repo_name", "year"] if period else ["repo_name"]
    entries = (
        members.repartition(*[F.col(k) for k in key])
        .groupBy(*key, "dev_id")
        .agg(F.collect_set("year").alias("years"))
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("dev_id", "years"))).alias("all"))
    )

    def after(a, i):
        later = F.filter(F.slice("all", i + 2, F.size("all")), lambda b: F.arrays_overlap(a["years"], b["years"]))
        return F.transform(later, lambda b: F.struct(a["dev_id"].alias("dev_a"), b["dev_id"].alias("dev_b")))

    return entries.select(*key, F.inline(F.flatten(F.transform("all", after))))


def co_edges(members: DataFrame, min_shared: int = MIN_SHARED, yearly: bool = False) -> DataFrame:
    """Pairs ``dev_a < dev_b`` with the number of repositories both touched in the same year.

    ``members`` must come from ``hubless``: no repository then has more members than its limit,
    and the pairs of one repository are bounded by the square of that limit. ``yearly`` gives the
    pairs of each year by itself, with a column ``year``.
    """
    key = ["dev_a", "dev_b", *(["year"] if yearly else [])]
    return (
        _pairs(members, yearly)
        .groupBy(*key)
        .agg(F.count("*").alias("shared_repos"))
        .where(F.col("shared_repos") >= min_shared)
    )

"""Distinct counts from stored sketches and at several levels of detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.operators import levels, serving, sketches
from adoptrend.plans.registry import query
from adoptrend.session import cut, scratch_path
from adoptrend.sources.inputs import Inputs, with_views


@query(
    "sketched_years",
    with_views(
        "enriched",
        body="""SELECT language, substr(year_month, 1, 4) AS year, count(DISTINCT repo_name) AS repos, true AS within
                FROM enriched GROUP BY 1, 2""",
    ),
)
def sketched_years(t: Inputs) -> DataFrame:
    """Distinct repositories a year from sketches of its months, next to the exact number."""
    facts = t.enriched.select("language", "year_month", "repo_name")
    path = scratch_path(t.spark, "sketches")
    late = F.col("year_month") >= "1998-06"
    # a first load that lacks some of its last month, then that month in full and what came after
    sketches.store_months(sketches.distinct_sketches(facts.where(~late | (F.col("year_month") == "1998-06") & F.col("repo_name").contains("1")), "repo_name"), path)
    sketches.store_months(sketches.distinct_sketches(facts.where(late), "repo_name"), path)
    year = F.substring("year_month", 1, 4).alias("year")
    found = sketches.distinct_of(sketches.stored(t.spark, path).withColumn("year", year), ["language", "year"])
    exact = facts.groupBy("language", year).agg(F.countDistinct("repo_name").alias("repos"))
    # up to a few hundred entities the sketch is as good as exact
    off = F.abs(F.col("estimate") - F.col("repos")) <= F.greatest(F.lit(1.0), sketches.distinct_bound() * F.col("repos"))
    return exact.join(found, ["language", "year"], "left").select("language", "year", "repos", F.coalesce(off, F.lit(False)).alias("within"))


@query(
    "sketched_groups",
    with_views(
        "enriched",
        body="""SELECT split_part(language, '-', 1) AS family, count(DISTINCT repo_name) AS repos, true AS within
                FROM enriched GROUP BY 1""",
    ),
)
def sketched_groups(t: Inputs) -> DataFrame:
    """The same for groups of categories over all months."""
    facts = t.enriched.select("language", "year_month", "repo_name")
    table = cut(sketches.distinct_sketches(facts, "repo_name"))
    family = F.split_part(F.col("language"), F.lit("-"), F.lit(1)).alias("family")
    found = sketches.distinct_of(table.withColumn("family", family), ["family"])
    exact = facts.groupBy(family).agg(F.countDistinct("repo_name").alias("repos"))
    off = F.abs(F.col("estimate") - F.col("repos")) <= F.greatest(F.lit(1.0), sketches.distinct_bound() * F.col("repos"))
    return exact.join(found, "family", "left").select("family", "repos", F.coalesce(off, F.lit(False)).alias("within"))


HALF = "CASE WHEN substr(year_month, 6, 2) <= '06' THEN 'H1' ELSE 'H2' END"


def levels_sql(groups: str) -> str:
    return with_views(
        "enriched",
        extra={"dated": f"SELECT language, substr(year_month, 1, 4) AS year, {HALF} AS half, repo_name, commit_count FROM enriched"},
        body=f"""SELECT language, year, half, CAST(GROUPING_ID(language, year, half) AS BIGINT) AS grouping_id,
                        count(DISTINCT repo_name) AS distinct_count, CAST(sum(commit_count) AS BIGINT) AS sum_commit_count
                 FROM dated GROUP BY {groups}""",
    )


def dated(t: Inputs) -> DataFrame:
    half = F.when(F.substring("year_month", 6, 2) <= "06", "H1").otherwise("H2")
    return t.enriched.select("language", F.substring("year_month", 1, 4).alias("year"), half.alias("half"), "repo_name", "commit_count")


DIMENSIONS = ["language", "year", "half"]


@query("cube_levels", levels_sql("CUBE (language, year, half)"))
def cube_levels(t: Inputs) -> DataFrame:
    return levels.distinct_at_levels(dated(t), "repo_name", DIMENSIONS, levels.cube_sets(DIMENSIONS), ["commit_count"])


@query("rollup_levels", levels_sql("ROLLUP (language, year, half)"))
def rollup_levels(t: Inputs) -> DataFrame:
    return levels.distinct_at_levels(dated(t), "repo_name", DIMENSIONS, levels.rollup_sets(DIMENSIONS), ["commit_count"])


@query("grouping_sets_levels", levels_sql("GROUPING SETS ((language, year), (half), ())"))
def grouping_sets_levels(t: Inputs) -> DataFrame:
    sets = [("language", "year"), ("half",), ()]
    return levels.distinct_at_levels(dated(t), "repo_name", DIMENSIONS, sets, ["commit_count"])


@query(
    "describe_sketched",
    with_views(
        "actor_stats",
        body=" UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS n, CAST(min({c}) AS DOUBLE) AS lowest, CAST(max({c}) AS DOUBLE) AS highest,
                       true AS within FROM actor_stats"""
            for c in ("distinct_repos", "total_commits")
        ),
    ),
)
def describe_sketched(t: Inputs) -> DataFrame:
    """Counts, extremes and quartiles of all columns in one pass; ``within``: the quartiles' ranks are right but for the bound."""
    columns = ["distinct_repos", "total_commits"]
    told = cut(serving.describe_once(t.actor_stats, columns))
    return serving.ranks_within(t.actor_stats, told, sketches.RANK_ERROR)

"""Monthly metrics and what is read off them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.operators import trends
from adoptrend.plans.registry import query
from adoptrend.sources.inputs import Inputs, with_views

HIGHLIGHTS = ["economy-7", "medium-21", "promo-33", "small-14"]

GROWN = """SELECT *, lag(repo_count) OVER (PARTITION BY language ORDER BY year_month) AS previous FROM monthly"""
GROWTH = "CASE WHEN previous > 0 THEN (repo_count - previous) / CAST(previous AS DOUBLE) END"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles as compared with the SQL: six decimals."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query("monthly_metrics", with_views("monthly", body="SELECT * FROM monthly"))
def monthly_metrics(t: Inputs) -> DataFrame:
    return t.monthly


@query(
    "mom_growth",
    with_views(
        "monthly",
        extra={"grown": GROWN},
        body=f"SELECT language, year_month, repo_count, previous, round({GROWTH}, 6) AS growth FROM grown",
    ),
)
def mom_growth(t: Inputs) -> DataFrame:
    return rounded(
        trends.mom_growth(t.monthly).select("language", "year_month", "repo_count", "previous", "growth"), "growth"
    )


@query(
    "growth_index",
    with_views(
        "monthly",
        body="""SELECT language, year_month, value, round(value / CAST(base AS DOUBLE) * 100, 6) AS idx FROM (
                  SELECT language, year_month, commit_count AS value,
                         first_value(commit_count) OVER (PARTITION BY language ORDER BY year_month) AS base
                  FROM monthly WHERE CAST(substr(year_month, 1, 4) AS INT) BETWEEN 1996 AND 1999) WHERE base > 0""",
    ),
)
def growth_index(t: Inputs) -> DataFrame:
    return rounded(trends.growth_index(t.monthly, "commit_count", 1996, 1999), "idx")


@query(
    "market_share",
    with_views(
        "monthly",
        body="""SELECT language, year_month, repo_count, month_total,
                       round(repo_count / CAST(month_total AS DOUBLE), 6) AS share
                FROM monthly JOIN (SELECT year_month, CAST(sum(repo_count) AS BIGINT) AS month_total
                                   FROM monthly GROUP BY 1) USING (year_month)""",
    ),
)
def market_share(t: Inputs) -> DataFrame:
    return rounded(trends.market_share(t.monthly_table), "share")


ORDINAL = "(CAST(substr({0}, 1, 4) AS INT) * 12 + CAST(substr({0}, 6, 2) AS INT))"


@query(
    "emergence_rank",
    with_views(
        "monthly",
        extra={"grown": GROWN},
        body=f"""SELECT language, round(recent_growth, 6) AS recent_growth, round(mean_repos, 6) AS mean_repos,
                        round(coalesce(recent_growth, 0) * ln(1 + mean_repos), 6) AS score
                 FROM (SELECT language, avg({GROWTH}) AS recent_growth, avg(repo_count) AS mean_repos
                       FROM (SELECT *, max(year_month) OVER (PARTITION BY language) AS last_month FROM grown)
                       WHERE {ORDINAL.format("last_month")} - {ORDINAL.format("year_month")} < 12 GROUP BY 1)""",
    ),
)
def emergence_rank(t: Inputs) -> DataFrame:
    return rounded(trends.emergence_rank(t.monthly), "recent_growth", "mean_repos", "score")


TOP = """SELECT language, avg(repo_count) AS mean_value FROM monthly GROUP BY 1
         ORDER BY mean_value DESC, language LIMIT {0}"""


@query(
    "top_languages",
    with_views(
        "monthly",
        extra={"best": TOP.format(30)},
        body="SELECT language, round(mean_value, 6) AS mean_value FROM best",
    ),
)
def top_languages(t: Inputs) -> DataFrame:
    return rounded(trends.top_categories(t.monthly), "mean_value")


@query(
    "latest_volume",
    with_views(
        "monthly",
        body="""SELECT language, year_month, total_bytes FROM monthly
                WHERE year_month = (SELECT max(year_month) FROM monthly)
                ORDER BY total_bytes DESC, language LIMIT 10""",
    ),
)
def latest_volume(t: Inputs) -> DataFrame:
    return trends.latest_volume(t.monthly_table)


HEAT = """SELECT language, substr(year_month, 1, 4) AS year, avg(repo_count) AS mean_value FROM monthly GROUP BY 1, 2"""


@query(
    "adoption_heatmap",
    with_views(
        "monthly",
        extra={"yearly": HEAT},
        body="""SELECT language, year, round(mean_value, 6) AS mean_value,
                       round(mean_value / first_value(mean_value) OVER (PARTITION BY language ORDER BY year), 6) AS multiple
                FROM yearly""",
    ),
)
def adoption_heatmap(t: Inputs) -> DataFrame:
    return rounded(trends.adoption_heatmap(t.monthly), "mean_value", "multiple")


YEARS = [str(y) for y in range(1995, 2002)]


@query(
    "adoption_heatmap_table",
    with_views(
        "monthly",
        extra={
            "yearly": HEAT,
            "scaled": """SELECT language, year, mean_value / first_value(mean_value)
                                OVER (PARTITION BY language ORDER BY year) AS multiple FROM yearly""",
        },
        body="SELECT language, "
        + ", ".join(f"round(max(multiple) FILTER (year = '{y}'), 6) AS y{y}" for y in YEARS)
        + " FROM scaled GROUP BY 1",
    ),
)
def adoption_heatmap_table(t: Inputs) -> DataFrame:
    wide = trends.heatmap_table(trends.adoption_heatmap(t.monthly), YEARS)
    return wide.select("language", *[F.round(F.col(y), 6).alias(f"y{y}") for y in YEARS])


@query(
    "trajectory_class",
    with_views(
        "monthly",
        body="""SELECT language, first_value, last_value, round(ratio, 6) AS ratio,
                       CASE WHEN ratio > 20 THEN 'explosive' WHEN ratio > 4 THEN 'strong' WHEN ratio > 1.2 THEN 'stable'
                            ELSE 'declining' END AS trajectory
                FROM (SELECT language, first_value, last_value,
                             last_value / CAST(greatest(1, first_value) AS DOUBLE) AS ratio
                      FROM (SELECT language, arg_min(repo_count, year_month) AS first_value,
                                   arg_max(repo_count, year_month) AS last_value FROM monthly GROUP BY 1))""",
    ),
)
def trajectory_class(t: Inputs) -> DataFrame:
    return rounded(trends.trajectory_class(t.monthly), "ratio")


@query(
    "highlight_pivot",
    with_views(
        "monthly",
        body="SELECT year_month, "
        + ", ".join(
            f"""CAST(coalesce(sum(repo_count) FILTER (language = '{h}'), 0) AS BIGINT) AS "{h.replace('-', '_')}\""""
            for h in HIGHLIGHTS
        )
        + " FROM monthly GROUP BY 1",
    ),
)
def highlight_pivot(t: Inputs) -> DataFrame:
    wide = trends.highlight_pivot(t.monthly, HIGHLIGHTS)
    return wide.select("year_month", *[F.col(f"`{h}`").alias(h.replace("-", "_")) for h in HIGHLIGHTS])

"""Monthly metrics per category and what is read off them.

Everything after ``monthly_metrics`` works on at most one row per (category, month); a window over
one category therefore never holds more rows than there are months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.functions.calendar import month_ordinal
from adoptrend.functions.fixed import MIN_MONTHS, TOP_SERIES, TRAJECTORY_BOUNDS, TRAJECTORY_ELSE


def _by_month():
    return Window.partitionBy("language").orderBy("year_month")


def monthly_metrics(enriched: DataFrame, min_months: int = MIN_MONTHS, approx: bool = False) -> DataFrame:
    """Size, distinct entities and activity per (category, month), for categories with enough months."""
    entities = F.approx_count_distinct("repo_name") if approx else F.countDistinct("repo_name")
    monthly = enriched.groupBy("language", "year_month").agg(
        F.sum("bytes").alias("total_bytes"),
        entities.alias("repo_count"),
        F.sum("commit_count").alias("commit_count"),
    )
    coverage = F.count("*").over(Window.partitionBy("language"))
    return monthly.withColumn("_months", coverage).where(F.col("_months") >= min_months).drop("_months")


def mom_growth(monthly: DataFrame, metric: str = "repo_count") -> DataFrame:
    """Relative change against the previous month that has data."""
    previous = F.lag(metric).over(_by_month())
    return monthly.withColumn("previous", previous).withColumn(
        "growth", F.when(F.col("previous") > 0, (F.col(metric) - F.col("previous")) / F.col("previous"))
    )


def growth_index(monthly: DataFrame, metric: str = "repo_count", lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Metric as a percentage of its first value within the years ``lo`` to ``hi``."""
    year = F.substring("year_month", 1, 4).cast("int")
    chosen = monthly
    if lo is not None:
        chosen = chosen.where(year >= lo)
    if hi is not None:
        chosen = chosen.where(year <= hi)
    base = F.first(metric).over(_by_month().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        chosen.withColumn("base", base)
        .where(F.col("base") > 0)
        .select("language", "year_month", F.col(metric).alias("value"), (F.col(metric) / F.col("base") * 100).alias("idx"))
    )


def market_share(monthly: DataFrame, metric: str = "repo_count") -> DataFrame:
    """Share of each category in the month's total."""
    totals = monthly.groupBy("year_month").agg(F.sum(metric).alias("month_total"))
    return monthly.join(totals, "year_month").select(
        "language", "year_month", metric, "month_total", F.try_divide(metric, "month_total").alias("share")
    )


def emergence_rank(monthly: DataFrame, months: int = 12) -> DataFrame:
    """Mean growth of each category's last ``months`` months, weighted by the log of its breadth.

    No formula was ever published for this ranking; this one favours steady growth that also
    reaches many entities.
    """
    grown = mom_growth(monthly)
    last = F.max("year_month").over(Window.partitionBy("language"))
    age = month_ordinal(F.col("_last")) - month_ordinal(F.col("year_month"))
    return (
        grown.withColumn("_last", last)
        .where(age < months)
        .groupBy("language")
        .agg(F.avg("growth").alias("recent_growth"), F.avg("repo_count").alias("mean_repos"))
        .withColumn("score", F.coalesce(F.col("recent_growth"), F.lit(0.0)) * F.log1p("mean_repos"))
    )


def top_categories(monthly: DataFrame, n: int = TOP_SERIES, metric: str = "repo_count") -> DataFrame:
    """The ``n`` categories with the highest mean, ties by name."""
    return (
        monthly.groupBy("language")
        .agg(F.avg(metric).alias("mean_value"))
        .orderBy(F.desc("mean_value"), "language")
        .limit(n)
    )


def latest_volume(monthly: DataFrame, n: int = 10) -> DataFrame:
    """Largest categories by size in the latest month."""
    latest = monthly.agg(F.max("year_month")).scalar()
    return (
        monthly.where(F.col("year_month") == latest)
        .select("language", "year_month", "total_bytes")
        .orderBy(F.desc("total_bytes"), "language")
        .limit(n)
    )


def adoption_heatmap(monthly: DataFrame, metric: str = "repo_count") -> DataFrame:
    """Yearly mean per category as a multiple of its first year."""
    yearly = monthly.groupBy("language", F.substring("year_month", 1, 4).alias("year")).agg(
        F.avg(metric).alias("mean_value")
    )
    first = F.first("mean_value").over(
        Window.partitionBy("language").orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return yearly.withColumn("multiple", F.try_divide(F.col("mean_value"), first))


def heatmap_table(heatmap: DataFrame, years: list[str]) -> DataFrame:
    """The heatmap with one column per year."""
    return heatmap.groupBy("language").pivot("year", years).agg(F.first("multiple"))


def trajectory_class(monthly: DataFrame, metric: str = "repo_count") -> DataFrame:
    """Name of each category's course, from the ratio of its last to its first value."""
    ends = monthly.groupBy("language").agg(
        F.min_by(metric, "year_month").alias("first_value"), F.max_by(metric, "year_month").alias("last_value")
    )
    ratio = F.col("last_value") / F.greatest(F.lit(1), F.col("first_value"))
    (bound, name), *rest = TRAJECTORY_BOUNDS
    label = F.when(F.col("ratio") > bound, name)
    for bound, name in rest:
        label = label.when(F.col("ratio") > bound, name)
    return ends.withColumn("ratio", ratio).withColumn("trajectory", label.otherwise(TRAJECTORY_ELSE))


def highlight_pivot(monthly: DataFrame, categories: list[str], metric: str = "repo_count") -> DataFrame:
    """One row per month, one column per highlighted category, 0 where it has no data."""
    return (
        monthly.groupBy("year_month")
        .pivot("language", categories)
        .agg(F.sum(metric))
        .fillna(0, subset=categories)
    )

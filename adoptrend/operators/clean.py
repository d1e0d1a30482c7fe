"""Cleaning of labels and activity, and the join that relates them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.functions.calendar import parse_month
from adoptrend.functions.fixed import EXCLUDED_LABELS, LAST_ACTIVITY_MONTH
from adoptrend.functions.text import normalise, present


def clean_labels(labels: DataFrame, exclude: Sequence[str] = EXCLUDED_LABELS) -> DataFrame:
    """Normalised, informative labels with the month the entity was created (NULL if unknown)."""
    return (
        labels.withColumn("language", normalise(F.col("language")))
        .where(present(F.col("language")) & ~F.col("language").isin(*exclude))
        .withColumn("created_month", parse_month(F.col("created_at")))
        .drop("created_at")
    )


def clean_activity(activity: DataFrame, cutoff: str = LAST_ACTIVITY_MONTH) -> DataFrame:
    """Positive monthly counts up to and including ``cutoff``."""
    return activity.where(
        F.col("year_month").isNotNull() & (F.col("commit_count") > 0) & (F.col("year_month") <= cutoff)
    ).withColumn("commit_count", F.col("commit_count").cast("long"))


def one_label_per_entity(labels: DataFrame) -> DataFrame:
    """One row per (entity, label): a repeated label must not multiply the activity joined to it."""
    return labels.groupBy("repo_name", "language").agg(
        F.max("bytes").cast("long").alias("bytes"), F.min("created_month").alias("created_month")
    )


def enrich(labels: DataFrame, activity: DataFrame) -> DataFrame:
    """Activity months under each label, without months before the entity existed."""
    alive = F.col("created_month").isNull() | (F.col("year_month") >= F.col("created_month"))
    return (
        one_label_per_entity(labels)
        .join(activity, "repo_name")
        .where(alive)
        .select("repo_name", "language", "bytes", "year_month", "commit_count")
    )


def join_diagnostics(labels: DataFrame, activity: DataFrame, key: str = "repo_name") -> DataFrame:
    """How many keys appear on one side only, and on both, from a single pass over each side."""
    sides = (
        labels.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_a"))
        .unionByName(activity.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_a")))
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("_l").alias("_l"), F.max("_a").alias("_a"))
    )
    return sides.agg(
        F.count_if((F.col("_l") == 1) & (F.col("_a") == 0)).alias("only_in_labels"),
        F.count_if((F.col("_l") == 0) & (F.col("_a") == 1)).alias("only_in_activity"),
        F.count_if((F.col("_l") == 1) & (F.col("_a") == 1)).alias("in_both"),
    )

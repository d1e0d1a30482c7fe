"""Stored sketches: distinct entities and quantiles of any range of months and group of categories, without the facts.

A sketch is a small binary per (category, month). Ranges and groups are unions of stored sketches.
A month that is written again replaces its own folder only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# 2 ** LG registers; the relative standard error is 1.04 / sqrt(2 ** LG), below 0.9 percent
LG = 14
# quantile sketches of this size are within 1.65 percent of the rank, 99 times in 100
K = 200
RANK_ERROR = 0.0165


def distinct_bound(lg: int = LG, sigmas: float = 4.0) -> float:
    """Relative error that an estimate stays within, but for one in 15,000 at four standard errors."""
    return sigmas * 1.04 / 2 ** (lg / 2)


def distinct_sketches(facts: DataFrame, entity: str, by: Sequence[str] = ("language", "year_month"), lg: int = LG) -> DataFrame:
    """``(*by, sketch)``: one sketch of the entities of each group. Absent entities don't count."""
    return facts.groupBy(*by).agg(F.hll_sketch_agg(entity, F.lit(lg)).alias("sketch"))


def store_months(sketches: DataFrame, path: str, month: str = "year_month") -> None:
    """Write sketches in one folder per month; only the months that ``sketches`` has are replaced."""
    (
        sketches.repartition(month)  # a month's sketches are few and become one file
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(month).parquet(path)
    )


def stored(spark: SparkSession, path: str, month: str = "year_month") -> DataFrame:
    """What ``store_months`` wrote; a range of months reads only its folders."""
    found = spark.read.parquet(path)
    return found.withColumn(month, F.col(month).cast("string"))


def distinct_of(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, estimate)``: distinct entities of groups of stored sketches. No sketches: no rows, or one of 0 without ``by``."""
    union = F.hll_union_agg("sketch")
    estimate = F.coalesce(F.hll_sketch_estimate(union), F.lit(0).cast("long"))
    return sketches.groupBy(*by).agg(estimate.alias("estimate"))


def quantile_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: int = K) -> DataFrame:
    """``(*by, <column>...)``: a sketch of each column's values per group, all in one pass. Absent values don't count."""
    values = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns]
    return df.groupBy(*by).agg(*values)


def merged_quantiles(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Stored quantile sketches of groups as one of each group of ``by``."""
    return sketches.groupBy(*by).agg(*[F.kll_merge_agg_double(c).alias(c) for c in columns])


def quantiles_of(sketch: str, probabilities: Sequence[float]) -> Column:
    """The values at ``probabilities`` of the rank, null where the sketch has seen none."""
    there = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(there, F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(p)) for p in probabilities])))

"""Joins on keys that may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptrend.session import cut, discard

# A key is heavy when it has more than one row in HEAVY_SHARE. There can be no more than
# HEAVY_SHARE such keys whatever the input, which bounds every broadcast below. A key with no more
# than HEAVY_ROWS rows is never worth a split.
HEAVY_SHARE = 1000
HEAVY_ROWS = 1000


def heavy_keys(df: DataFrame, key: str, total: int, least: int = HEAVY_ROWS) -> DataFrame:
    """At most HEAVY_SHARE rows (key, _parts): keys to be split, and in how many parts."""
    limit = max(least, -(-total // HEAVY_SHARE))
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > limit)
        .select(key, F.ceil(F.col("_rows") / limit).cast("int").alias("_parts"))
    )


def lookup(
    left: DataFrame, right: DataFrame, key: str, total: int, least: int = HEAVY_ROWS, columns: Sequence = ("*",)
) -> DataFrame:
    """``columns`` of the inner join of ``left``, of ``total`` rows, with a ``right`` side unique on ``key``.

    Rows of a heavy key meet their one partner through a broadcast of at most HEAVY_SHARE rows;
    all others take the usual join. ``left`` is read three times and should be materialised; the
    result is.
    """
    heavy = cut(heavy_keys(left, key, total, least).select(key))
    partners = right.join(F.broadcast(heavy), key, "left_semi")
    split = left.join(F.broadcast(partners), key)
    usual = left.join(F.broadcast(heavy), key, "left_anti").join(right, key)
    joined = cut(split.unionByName(usual).select(*columns))
    discard(heavy)
    return joined

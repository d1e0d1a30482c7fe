"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_partitioned(df: DataFrame, path: str, key: str) -> None:
    """Overwrite ``path``, one folder per value of ``key``.

    ``rebalance`` gathers the rows of a folder in few files, and still splits a value that holds
    much of the data over several tasks.
    """
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)


def write_table(df: DataFrame, path: str, files: int | None = None, rows_per_file: int | None = None) -> None:
    """Overwrite ``path`` with Snappy Parquet."""
    out = df.repartition(files) if files else df
    writer = out.write.mode("overwrite").option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def export_tables(tables: dict[str, DataFrame], base: str) -> None:
    """Each named table under ``base``."""
    for name, df in tables.items():
        write_table(df, f"{base.rstrip('/')}/{name}")


def write_json(df: DataFrame, path: str) -> None:
    """Slim serving export: one JSON object per line."""
    df.write.mode("overwrite").json(path)


def read_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """A written table; with ``like`` in that frame's columns and types, also for folder keys."""
    if like is None:
        return spark.read.parquet(path)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)

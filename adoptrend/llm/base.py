"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# a word is a run of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch. A batch of long texts has to fit in a Python worker beside the model.
BATCH_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


@contextmanager
def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows and 16 MB for what is written inside; the caller's settings come back."""
    ours = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    }
    before = {key: spark.conf.get(key) for key in ours}
    try:
        for key, value in ours.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row: the optimizer doesn't merge projections across a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def whole(text: str = "text") -> Column:
    """The text, an absent one as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: a fifth, by CRC-32 of the id as text. A row without id is none of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned_rows(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``(doc_id, y)``: at most ``limit`` labelled rows outside the held-out fifth, the same ones in every run.

    Repeated labels of a document count once, as their smallest; absent ones not at all. The rows
    are those with the smallest hash of the id, so any order or layout of the table gives the same.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )

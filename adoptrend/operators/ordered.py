"""Global order without a global task.

Ranks, running totals, exact quantiles and previous-row lookups need an order over data of any
size, and one key may own a third of it. The rows are range-partitioned on the full sort key, so
a hot key is spread over as many chunks as its share calls for; each chunk works alone, and what
crosses a chunk border is one row per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.session import cut, discard, held

CHUNK = "_chunk"


def ordered_chunks(df: DataFrame, order: Sequence[str], chunks: int | None = None) -> DataFrame:
    """Rows with the number of the range they fall in, ascending in ``order``.

    Without a number of chunks, adjacent ranges are merged at run time until each is worth a task.
    The result is materialised, so that every later use sees the same borders.
    """
    columns = [F.col(c) for c in order]
    # the borders are sampled before the rows move: without a written input all of it would run twice
    df, mine = held(df)
    ranged = df.repartitionByRange(chunks, *columns) if chunks else df.repartitionByRange(*columns)
    done = cut(ranged.withColumn(CHUNK, F.spark_partition_id()))
    if mine:
        discard(df)
    return done


def running_total(df: DataFrame, order: Sequence[str], weight: str, out: str, chunks: int | None = None) -> DataFrame:
    """Inclusive running sum of ``weight`` over the whole input; ``order`` must be unique."""
    ranged = ordered_chunks(df, order, chunks)
    # one row per chunk: the window below sees no more rows than there are chunks
    totals = ranged.groupBy(CHUNK).agg(F.sum(weight).alias("_total"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(CHUNK, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy(CHUNK)
        .orderBy(*[F.col(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        ranged.withColumn("_inside", F.sum(weight).over(inside))
        .join(F.broadcast(offsets), CHUNK)
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_inside", "_offset", CHUNK)
    )


def global_rank(df: DataFrame, order: Sequence[str], out: str, chunks: int | None = None) -> DataFrame:
    """Dense position 0, 1, 2, ... in ``order``."""
    counted = running_total(df.withColumn("_one", F.lit(1).cast("long")), order, "_one", out, chunks)
    return counted.withColumn(out, F.col(out) - 1).drop("_one")


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str, chunks: int | None = None
) -> DataFrame:
    """``lag(value)`` within ``keys`` by ``order``, for keys of any size.

    Only a key that runs over a chunk border needs the row before the border, and a chunk
    continues at most one key: the table of carried values has fewer rows than there are chunks.
    """
    ranged = ordered_chunks(df, [*keys, *order], chunks)
    inside = Window.partitionBy(CHUNK, *keys).orderBy(*[F.col(c) for c in order])
    tails = ranged.groupBy(CHUNK, *keys).agg(F.max_by(value, F.struct(*order)).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    carried = (
        tails.withColumn("_carried", F.lag("_tail").over(across))
        .where(F.col("_carried").isNotNull())
        .select(F.col(CHUNK).alias("_in"), *[F.col(k).alias(f"_key_{k}") for k in keys], "_carried")
    )
    same = F.col(CHUNK) == F.col("_in")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return (
        ranged.withColumn("_position", F.row_number().over(inside))
        .withColumn("_within", F.lag(value).over(inside))
        .join(F.broadcast(carried), same, "left")
        .withColumn(out, F.when(F.col("_position") == 1, F.col("_carried")).otherwise(F.col("_within")))
        .drop("_position", "_within", "_carried", CHUNK, "_in", *[f"_key_{k}" for k in keys])
    )


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], prefix: str = "q") -> DataFrame:
    """One row of linearly interpolated quantiles; NULLs are left out.

    Equal values are counted before anything is ordered, so a value that a third of the rows
    share is one row here.
    """
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    placed = running_total(counts, ["_value"], "_n", "_upto")
    total = placed.agg(F.max("_upto")).scalar()
    spots = placed.withColumn("_total", total).withColumn("_from", F.col("_upto") - F.col("_n"))

    def at(position):
        return F.max(F.when((F.col("_from") <= position) & (position < F.col("_upto")), F.col("_value").cast("double")))

    columns = []
    for p in probabilities:
        exact = (F.col("_total") - 1) * F.lit(float(p))
        columns.append(at(F.floor(exact)).alias(f"_lo_{p}"))
        columns.append(at(F.ceil(exact)).alias(f"_hi_{p}"))
        columns.append(F.max(exact - F.floor(exact)).alias(f"_part_{p}"))
    row = spots.agg(*columns)
    return row.select(
        *[
            (F.col(f"`_lo_{p}`") + (F.col(f"`_hi_{p}`") - F.col(f"`_lo_{p}`")) * F.col(f"`_part_{p}`")).alias(
                f"{prefix}{round(p * 100)}"
            )
            for p in probabilities
        ]
    )

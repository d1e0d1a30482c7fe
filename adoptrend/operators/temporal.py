"""Joins by time: the last row before each row, and rows whose periods overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adoptrend.operators.ordered import CHUNK, ordered_chunks
from adoptrend.session import held

# bins of one level that a period may touch before it goes to the next, and how much wider that one's bins are
TOUCHED, FAN = 2, 4


def _known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(f"`{c}`").isNotNull()
    return known


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    found_time: str = "found_time",
    within: Column | None = None,
    chunks: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with ``values`` of the last row of ``right`` at or before its time, under the same keys.

    ``found_time`` is the time of that row. Of rows of ``right`` at one time the one with the greatest
    values counts. ``within`` is an interval: older rows don't count. A row whose key or time is
    absent finds nothing, like one before the first of ``right``; repeated rows of ``left`` stay. The
    names of ``values`` and ``found_time`` must not be columns of ``left``.

    Both sides are range-partitioned in one order of key and time, so a key of any size is spread over
    as many chunks as it needs; the last row of a key is carried over chunk borders, one row per chunk.
    """
    taken = {*values, found_time} & set(left.columns)
    if taken:
        raise ValueError(f"columns of both sides: {sorted(taken)}")
    marks = [f"_k{i}" for i in range(len(keys))]

    def side(df: DataFrame, time: str, number: int, row: Column, value: Column) -> DataFrame:
        named = [F.col(f"`{k}`").alias(m) for k, m in zip(keys, marks, strict=True)]
        return df.where(_known([*keys, time])).select(
            *named, F.col(f"`{time}`").alias("_at"), F.lit(number).alias("_side"), value.alias("_value"), row.alias("_row")
        )

    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    value = F.struct(F.col(f"`{right_time}`").alias(found_time), *[F.col(f"`{v}`") for v in values])
    kinds = left.select(whole.alias("r")), right.select(value.alias("v"))
    none_row, none_value = (F.lit(None).cast(k.schema[0].dataType) for k in kinds)
    # at one time the rows of the right come first, the greatest value last of them
    rows = side(right, right_time, 0, none_row, value).unionByName(side(left, left_time, 1, whole, none_value))
    order = [*marks, "_at", "_side", "_value"]
    ranged = ordered_chunks(rows, order, chunks)
    inside = (
        Window.partitionBy(CHUNK, *marks).orderBy("_at", "_side", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )

    # one row per chunk: its first and last key, and what the last key leaves to the next chunk
    key = F.struct(*marks)
    ends = ranged.groupBy(CHUNK).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    tail = F.max_by("_value", F.when(F.col("_side") == 0, F.struct("_at", "_value"))).alias("_tail")
    tails = ranged.groupBy(CHUNK, *marks).agg(tail).select(CHUNK, key.alias("_last"), "_tail")
    ends = ends.join(tails, [CHUNK, "_last"])
    along, of_key = Window.orderBy(CHUNK), Window.partitionBy("_last").orderBy(CHUNK)
    kept = ends.withColumn("_upto", F.last("_tail", ignorenulls=True).over(of_key))
    carried = (
        kept.withColumn("_before", F.lag(F.struct("_last", "_upto")).over(along))
        .where(F.col("_before._last") == F.col("_first"))
        .select(F.col(CHUNK).alias("_in"), F.col("_first").alias("_key"), F.col("_before._upto").alias("_carried"))
        .where("_carried IS NOT NULL")
    )
    told = (
        ranged.withColumn("_near", F.last("_value", ignorenulls=True).over(inside))
        .where("_side = 1")
        .join(F.broadcast(carried), (F.col(CHUNK) == F.col("_in")) & (key == F.col("_key")), "left")
        .withColumn("_found", F.coalesce("_near", "_carried"))
    )
    if within is not None:
        fresh = F.col("_at") <= F.col(f"_found.`{found_time}`") + within
        told = told.withColumn("_found", F.when(fresh, F.col("_found")))
    matched = told.select("_row.*", "_found.*")
    lost = left.where(~_known([*keys, left_time]))
    return matched.unionByName(lost, allowMissingColumns=True).select(*[f"`{c}`" for c in left.columns], found_time, *[f"`{v}`" for v in values])


def _bin(x: Column, size: Column) -> Column:
    """The number of the bin of ``x``, whole numbers throughout."""
    return ((x - F.pmod(x, size)) / size).cast("long")


def _level(first: Column, last: Column, width: int, levels: int) -> Column:
    """The finest level at which a period touches at most ``TOUCHED`` bins; the last level takes the rest."""
    level = F.lit(levels - 1)
    for i in reversed(range(levels - 1)):
        size = F.lit(width * FAN**i).cast("long")
        level = F.when(_bin(last, size) - _bin(first, size) < TOUCHED, F.lit(i)).otherwise(level)
    return level


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_period: tuple[str, str],
    right_period: tuple[str, str],
    width: int,
    levels: int = 12,
) -> DataFrame:
    """``(l, r)``, structs of the rows of ``left`` and ``right`` with the same keys whose periods overlap.

    Periods are pairs of whole-number columns, both ends included; a period with an absent end or key,
    or that ends before it starts, overlaps none. Repeated rows pair each time.

    Of two overlapping periods one starts within the other. Time is cut into bins, ``width`` wide at
    the finest level and ``FAN`` times wider at each next. A period lives at the finest level where it
    touches few bins; its start visits the one bin it falls in at each level where the other side
    lives. So a pair is found once, in the bin of the later start, those of the left where both start
    together. A period goes to at most ``TOUCHED`` bins, its start to one a level. ``width`` should be that
    of a usual period; from the widest bins on, ``width`` * 4 ** (``levels`` - 1), a longer period goes
    to as many as it touches. Both sides are written first, once where they are the same table.
    """
    marks = [f"_k{i}" for i in range(len(keys))]

    def binned(df: DataFrame, period: tuple[str, str], name: str) -> DataFrame:
        start, end = (F.col(f"`{p}`").cast("long") for p in period)
        named = [F.col(f"`{k}`").alias(m) for k, m in zip(keys, marks, strict=True)]
        placed = df.where(_known([*keys, *period]) & (start <= end)).select(
            *named, start.alias("_s"), end.alias("_e"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
        )
        return placed.withColumn("_own", _level(F.col("_s"), F.col("_e"), width, levels))

    itself = left is right
    left = held(left)[0]
    right = left if itself else held(right)[0]
    l, r = binned(left, left_period, "l"), binned(right, right_period, "r")

    def lives(df: DataFrame) -> list[int]:
        """The levels at which something lives, no more than ``levels``."""
        return sorted(row.level for row in df.select(F.col("_own").alias("level")).distinct().collect())

    size = F.lit(width).cast("long") * F.pow(F.lit(FAN), F.col("_level")).cast("long")

    def whole(df: DataFrame, name: str) -> DataFrame:
        """Periods at the bins of the level where they live."""
        placed = df.withColumn("_level", F.col("_own"))
        bins = F.explode(F.sequence(_bin(F.col("_s"), size), _bin(F.col("_e"), size)))
        return placed.select(*marks, "_level", bins.alias("_bin"), F.col("_s").alias("_from"), F.col("_e").alias("_to"), name)

    def starts(df: DataFrame, name: str, visited: list[int]) -> DataFrame:
        """The starts of periods at the bin of each level where the other side lives."""
        placed = df.withColumn("_level", F.explode(F.array(*[F.lit(v).cast("int") for v in visited]).cast("array<int>")))
        return placed.select(*marks, "_level", _bin(F.col("_s"), size).alias("_bin"), F.col("_s").alias("_start"), name)

    l_lives = lives(l)
    r_lives = l_lives if itself and left_period == right_period else lives(r)
    meeting = [*marks, "_level", "_bin"]
    later_l = starts(l, "l", r_lives).join(whole(r, "r"), meeting).where("_from <= _start AND _start <= _to")
    later_r = whole(l, "l").join(starts(r, "r", l_lives), meeting).where("_from < _start AND _start <= _to")
    return later_l.select("l", "r").unionByName(later_r.select("l", "r"))

"""Distinct counts at many levels of detail: cube, rollup and grouping sets over one pass of the entities.

A distinct count can't be added up from finer levels, and expanding every fact by every level before
the shuffle moves them as often as there are levels. Here each entity's combinations of dimensions are
gathered once; for each level the entity counts once under each distinct combination it has there,
so what is counted after that is plain, and is summed before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dimensions[:n]) for n in range(len(dimensions), -1, -1)]


def cube_sets(dimensions: Sequence[str]) -> list[tuple[str, ...]]:
    return [c for n in range(len(dimensions), -1, -1) for c in combinations(dimensions, n)]


def grouping_id(dimensions: Sequence[str], kept: Sequence[str]) -> int:
    """A bit for each dimension, the first the highest, set where it is summed over."""
    return sum(1 << i for i, d in enumerate(reversed(dimensions)) if d not in kept)


def distinct_at_levels(
    facts: DataFrame, entity: str, dimensions: Sequence[str], sets: Sequence[Sequence[str]], sums: Sequence[str] = ()
) -> DataFrame:
    """``(*dimensions, grouping_id, distinct_count, sum_<c>...)``, one row for each group of each set.

    As with GROUPING SETS, a dimension that is summed over is null and ``grouping_id`` tells it from
    an absent value. An absent entity isn't counted, but its rows count in the sums. The empty set
    has no row where there are no facts. Two exchanges, whatever the number of sets: one by entity,
    one by group. An entity's combinations (as many as the dimensions have, at most) meet in one task;
    for each set they are sorted, so that equal ones stand side by side and the first of them counts.
    What is spread over the sets is summed by group alone: no table of (entity, group) is held.
    """
    values = F.struct(*[F.col(d).alias(d) for d in dimensions])
    totals = [F.sum(c).alias(c) for c in sums]
    fine = facts.groupBy(F.col(entity).alias("_entity"), values.alias("_at")).agg(*totals) if sums else (
        facts.where(F.col(entity).isNotNull()).select(F.col(entity).alias("_entity"), values.alias("_at")).distinct()
    )
    per_entity = fine.groupBy("_entity").agg(F.collect_list(F.struct("_at", *sums)).alias("_rows"))

    def sorted_at(kept: Sequence[str]):
        def masked(row):
            parts = [(row["_at"][d] if d in kept else F.lit(None).cast(facts.schema[d].dataType)).alias(d) for d in dimensions]
            group = F.struct(*parts, F.lit(grouping_id(dimensions, kept)).cast("long").alias("grouping_id"))
            return F.struct(group.alias("group"), *[row[c].alias(c) for c in sums])

        return F.sort_array(F.transform("_rows", masked))

    def first_counts(rows: str):
        def marked(row, i):
            again = (i > 0) & row["group"].eqNullSafe(F.get(F.col(rows), i - 1)["group"])
            n = F.when(again | F.col("_entity").isNull(), 0).otherwise(1)
            return F.struct(row["group"].alias("group"), n.alias("_first"), *[row[c].alias(c) for c in sums])

        return F.transform(rows, marked)

    names = [f"_set{i}" for i in range(len(sets))]
    listed = per_entity.select("_entity", *[sorted_at(kept).alias(n) for n, kept in zip(names, sets, strict=True)])
    spread = listed.select(F.explode(F.flatten(F.array(*[first_counts(n) for n in names]))).alias("m"))
    counted = spread.groupBy("m.group").agg(
        F.coalesce(F.sum("m._first"), F.lit(0)).alias("distinct_count"), *[F.sum(f"m.{c}").alias(f"sum_{c}") for c in sums]
    )
    return counted.select("group.*", "distinct_count", *[f"sum_{c}" for c in sums])

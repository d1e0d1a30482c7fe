from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adoptrend.operators import levels, serving, sketches, temporal
from adoptrend.session import scratch_path


def latest(left, right, within=None):
    out = []
    for n, k, t in left:
        found = [(s, v) for q, s, v in right if None not in (k, t, q, s) and q == k and s <= t]
        s, v = max(found, key=lambda x: (x[0], x[1] is not None, x[1] or "")) if found else (None, None)
        if within is not None and s is not None and t > s + within:
            s, v = None, None
        out.append((n, k, t, s, v))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunks", [None, 1, 9])
def test_asof_join(spark, rows, chunks):
    pick = random.Random(2)
    # a third of all rows under one key, which has to go over chunk borders; long stretches without a label
    key = lambda: pick.choice(["hot", f"k{pick.randrange(12)}", f"k{pick.randrange(12)}"])
    left = [(n, key(), pick.randrange(1000)) for n in range(400)] + [(900, None, 5), (901, "hot", None), (902, "k1", -5), (903, "new", 5), (904, "k2", 7), (904, "k2", 7)]
    right = [(key(), pick.randrange(1000), pick.choice("abc")) for _ in range(60)]
    right += [("hot", 3, "x"), (None, 1, "n"), ("k1", None, "n"), ("k3", 9, None), ("k3", 9, "t"), ("k3", 9, "s")]
    a = spark.createDataFrame(left, "n long, k string, t long")
    b = spark.createDataFrame(right, "q string, s long, v string").withColumnsRenamed({"q": "k"})
    got = temporal.asof_join(a, b, ["k"], "t", "s", ["v"], "s", chunks=chunks)
    assert got.columns == ["n", "k", "t", "s", "v"] and rows(got) == latest(left, right)
    near = temporal.asof_join(a, b, ["k"], "t", "s", ["v"], "s", within=F.lit(50), chunks=chunks)
    assert rows(near) == latest(left, right, 50)
    assert rows(temporal.asof_join(a, b.limit(0), ["k"], "t", "s", ["v"], "s")) == latest(left, [])
    assert temporal.asof_join(a.limit(0), b, ["k"], "t", "s", ["v"], "s").count() == 0
    with pytest.raises(ValueError):
        temporal.asof_join(a, b, ["k"], "t", "s", ["v"], "t")


def test_overlap_join(spark):
    pick = random.Random(3)

    def periods(n):
        out = []
        for i in range(n):
            start = pick.randrange(-500, 5000)
            out.append((i, pick.choice(["hot", "a", "b"]), start, start + pick.choice([0, 1, 5, 40, 700, 6000])))
        return [*out, (n, None, 0, 9), (n + 1, "a", None, 9), (n + 2, "a", 9, None), (n + 3, "a", 9, 3), (7, "b", -20, 20), (7, "b", -20, 20)]

    left, right = periods(150), periods(120)
    a = spark.createDataFrame(left, "n long, k string, s long, e long")
    b = spark.createDataFrame(right, "m long, k string, s long, e long")
    want = sorted(
        (x[0], y[0]) for x in left for y in right
        if None not in (*x, *y) and x[1] == y[1] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3]
    )
    for width, depth in ((4, 12), (10_000, 2), (1, 3)):
        found = temporal.overlap_join(a, b, ["k"], ("s", "e"), ("s", "e"), width, depth)
        assert sorted(found.select("l.n", "r.m").collect()) == want, (width, depth)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert temporal.overlap_join(a.limit(0), b, ["k"], ("s", "e"), ("s", "e"), 4).count() == 0
    # one table with itself
    own = temporal.overlap_join(a, a, ["k"], ("s", "e"), ("s", "e"), 4)
    valid = [x for x in left if None not in x and x[2] <= x[3]]
    assert own.count() == sum(x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3] for x in valid for y in valid)


def test_distinct_at_levels(spark, rows):
    pick = random.Random(4)
    facts = [(pick.choice(["e1", None, *[f"e{pick.randrange(9)}"] * 3]), pick.choice(["a", "b", None]), pick.choice([1, 2]), pick.randrange(5)) for _ in range(80)]
    df = spark.createDataFrame(facts, "entity string, a string, b int, n long")
    sets = levels.cube_sets(["a", "b"])
    assert sets == [("a", "b"), ("a",), ("b",), ()] and levels.rollup_sets(["a", "b"]) == [("a", "b"), ("a",), ()]
    want, sums = defaultdict(set), defaultdict(int)
    for e, a, b, n in facts:
        for kept in sets:
            at = (a if "a" in kept else None, b if "b" in kept else None, levels.grouping_id(["a", "b"], kept))
            want[at] |= {e} - {None}
            sums[at] += n
    got = rows(levels.distinct_at_levels(df, "entity", ["a", "b"], sets, ["n"]))
    assert got == sorted(((*at, len(e), sums[at]) for at, e in want.items()), key=repr)
    bare = rows(levels.distinct_at_levels(df, "entity", ["a", "b"], sets))
    assert bare == sorted(((*at, len(e)) for at, e in want.items() if e), key=repr)
    assert levels.distinct_at_levels(df.limit(0), "entity", ["a", "b"], sets, ["n"]).count() == 0
    plan = levels.distinct_at_levels(df, "entity", ["a", "b"], sets)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3


def test_stored_sketches(spark):
    facts = spark.range(60_000).select(
        (F.col("id") % 3).cast("string").alias("language"), F.concat(F.lit("2020-0"), (F.col("id") % 4 + 1).cast("string")).alias("year_month"),
        F.when(F.col("id") % 10 > 0, F.col("id") % 20_000).alias("repo"),
    )
    path = scratch_path(spark, "sketches")
    sketches.store_months(sketches.distinct_sketches(facts.where("repo < 50"), "repo"), path)
    sketches.store_months(sketches.distinct_sketches(facts, "repo"), path)  # replaces what was there
    extra = facts.limit(1).select("language", F.lit("2020-09").alias("year_month"), F.lit(1).cast("long").alias("repo"))
    sketches.store_months(sketches.distinct_sketches(extra, "repo"), path)  # and leaves other months alone
    table = sketches.stored(spark, path)
    assert table.select("year_month").distinct().count() == 5
    exact = {r[0]: r[1] for r in facts.groupBy("language").agg(F.countDistinct("repo")).collect()}
    for r in sketches.distinct_of(table.where("year_month < '2020-09'"), ["language"]).collect():
        assert abs(r.estimate - exact[r.language]) <= sketches.distinct_bound() * exact[r.language]
    assert abs(sketches.distinct_of(table).first()[0] - 18_000) <= sketches.distinct_bound() * 18_000
    assert sketches.distinct_of(table.limit(0)).first()[0] == 0


def test_quantiles_in_one_pass(spark):
    df = spark.range(20_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("x"), F.when(F.col("id") % 2 == 0, F.exp(F.col("id") / 3000.0)).alias("y"), F.lit(None).cast("long").alias("none"),
        (F.col("id") % 4).alias("part"),
    )
    told = serving.describe_once(df, ["x", "y", "none"])
    found = {r.column: r for r in told.collect()}
    assert (found["y"].n, found["none"].n, found["none"].q50, found["x"].lowest) == (10_000, 0, None, 0)
    assert all(r.within for r in serving.ranks_within(df, told, sketches.RANK_ERROR).collect())
    moved = told.withColumn("q50", F.lit(9e9))
    assert not serving.ranks_within(df, moved, sketches.RANK_ERROR).where("column = 'x'").first().within
    parts = sketches.quantile_sketches(df, ["x", "y"], ["part"])
    both = sketches.merged_quantiles(parts, ["x", "y"]).select(sketches.quantiles_of("x", (0.1, 0.9)).alias("q")).first().q
    for p, q in zip((0.1, 0.9), both, strict=True):
        assert abs(df.where(F.col("x") <= q).count() / 20_000 - p) <= 2 * sketches.RANK_ERROR

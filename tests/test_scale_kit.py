"""Order, skew, sinks, streaming and features."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from adoptrend.functions.fixed import FEATURES
from adoptrend.operators import features as ft
from adoptrend.operators import migration, ordered, serving, skew
from adoptrend.session import scratch_path, shared_dir
from adoptrend.sources import sinks
from adoptrend.streaming import activity


def test_previous_value_with_a_hot_key(spark):
    pick = random.Random(0)
    data = [(0 if pick.random() < 0.6 else pick.randint(1, 30), i, f"v{pick.randint(0, 5)}") for i in range(600)]
    df = spark.createDataFrame(data, "k int, t int, v string").repartition(5)
    got = {(r.k, r.t): r.before for r in ordered.previous_value(df, ["k"], ["t"], "v", "before", chunks=7).collect()}
    last, expected = {}, {}
    for k, t, v in sorted(data):
        expected[k, t] = last.get(k)
        last[k] = v
    assert got == expected
    # the hot key does run over chunk borders
    assert ordered.ordered_chunks(df, ["k", "t"], 7).where("k = 0").select("_chunk").distinct().count() > 2


def test_global_rank_and_running_total(spark):
    values = random.Random(1).sample(range(10_000), 500)
    df = spark.createDataFrame([(v, v % 7) for v in values], "x int, w int")
    place = {r.x: r.n for r in ordered.global_rank(df, ["x"], "n", chunks=6).collect()}
    assert place == {v: i for i, v in enumerate(sorted(values))}
    total = {r.x: r.s for r in ordered.running_total(df, ["x"], "w", "s", chunks=6).collect()}
    assert [total[v] for v in sorted(values)] == list(np.cumsum([v % 7 for v in sorted(values)]))


def test_exact_quantiles(spark):
    pick = random.Random(2)
    values = [3.0] * 300 + [pick.random() * 10 for _ in range(401)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    row = ordered.exact_quantiles(df, "x", (0.0, 0.25, 0.5, 0.9, 1.0)).first()
    assert list(row) == pytest.approx(list(np.quantile(values, (0.0, 0.25, 0.5, 0.9, 1.0))))


def test_lookup_splits_heavy_keys(spark):
    left = spark.createDataFrame([(7 if i % 3 else i, i) for i in range(300)], "k long, i long")
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = skew.lookup(left, right, "k", 300, least=20)
    assert sorted((r.k, r.i, r.v) for r in joined.collect()) == sorted((7 if i % 3 else i, i, 2 * (7 if i % 3 else i)) for i in range(300))
    assert [r.k for r in skew.heavy_keys(left, "k", 300, 20).collect()] == [7]


def test_heavy_keys_are_bounded(spark):
    df = spark.range(5000).select((F.col("id") % 2500).alias("k"))
    assert skew.heavy_keys(df, "k", 5000, 1).count() <= skew.HEAVY_SHARE


def test_sinks(spark, rows):
    df = spark.createDataFrame([("1", 5, "x"), ("b", 6, "y")], "language string, n long, t string")
    path = scratch_path(spark, "t")
    assert path.startswith(shared_dir(spark))
    sinks.write_partitioned(df, path, "language")
    assert rows(sinks.read_table(spark, path, df)) == rows(df)
    sinks.write_partitioned(df.limit(1), path, "language")
    assert sinks.read_table(spark, path, df).count() == 1
    base = scratch_path(spark, "base")
    sinks.export_tables({"one": df, "two": df.limit(1)}, base)
    assert sinks.read_table(spark, f"{base}/two").count() == 1
    sinks.write_json(df, f"{base}/json")
    assert rows(spark.read.schema(df.schema).json(f"{base}/json")) == rows(df)
    sinks.write_table(spark.range(100), f"{base}/many", files=1, rows_per_file=30)
    assert len(spark.read.parquet(f"{base}/many").inputFiles()) == 4


def test_stream_equals_batch_and_drops_late_rows(spark, rows):
    folder, table, progress = (scratch_path(spark, x) for x in ("log", "table", "progress"))
    start = datetime(2024, 1, 1)
    first = [(i, start + timedelta(hours=i), "ab"[i % 2]) for i in range(72)]
    schema = "event_id int, ts timestamp, kind string"
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(f"{folder}/p=0")
    log = lambda: activity.read_log(spark, folder + "/*", spark.createDataFrame([], schema).schema)
    activity.maintain(activity.tumbling_counts(log(), "kind"), table, progress)
    batch = spark.createDataFrame(first, schema).groupBy(F.window("ts", "1 day").start.alias("window_start"), "kind").agg(F.count("*").alias("n"))
    assert rows(activity.current_counts(spark, table, "kind")) == rows(batch)
    late = [(100, start, "a"), (101, start + timedelta(hours=71, minutes=5), "a")]
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(f"{folder}/p=1")
    activity.maintain(activity.tumbling_counts(log(), "kind"), table, progress)
    now = {(r.window_start, r.kind): r.n for r in activity.current_counts(spark, table, "kind").collect()}
    assert now[start, "a"] == 12 and now[start + timedelta(days=2), "a"] == 13
    folders = lambda: sorted(f for f in os.listdir(table.removeprefix("file:")) if f.startswith("batch="))
    assert len(folders()) > 1
    for _ in range(2):
        activity.compact(spark, table, "kind")
        assert len(folders()) == 1
        assert {(r.window_start, r.kind): r.n for r in activity.current_counts(spark, table, "kind").collect()} == now
    # a later batch wins over the merged ones, and joins them
    more = [(200 + i, start + timedelta(hours=72 + i), "a") for i in range(3)]
    spark.createDataFrame(more, schema).coalesce(1).write.parquet(f"{folder}/p=2")
    activity.maintain(activity.tumbling_counts(log(), "kind"), table, progress)
    activity.compact(spark, table, "kind")
    after = {(r.window_start, r.kind): r.n for r in activity.current_counts(spark, table, "kind").collect()}
    assert after == {**now, (start + timedelta(days=3), "a"): 3} and len(folders()) == 1


@pytest.fixture
def features(spark):
    pick = np.random.default_rng(3)
    data = [(f"l{i}", *[float(x) for x in pick.normal(5 * (i % 3), 0.3, 4)], 1.0) for i in range(60)]
    return spark.createDataFrame(data, "language string, " + ", ".join(f"{c} double" for c in FEATURES))


def test_clusters(features):
    rows, centres, silhouette = ft.cluster(features, k=3, score=True)
    found = {r.language: r.cluster for r in rows.collect()}
    assert len({tuple(sorted(n for n, c in found.items() if c == k)) for k in range(3)}) == 3 and silhouette > 0.9
    assert all(len({found[f"l{i}"] for i in range(start, 60, 3)}) == 1 for start in range(3))
    nearest = {r.language: r.cluster for r in ft.assign(ft.zscores(features), centres).collect()}
    assert nearest == found
    sweep = {r.k: r.silhouette for r in ft.k_sweep(features, (2, 3)).collect()}
    assert sweep[3] > sweep[2]
    profile = ft.cluster_profiles(rows).collect()
    assert {round(r.avg_repo_growth, 6) for r in profile} >= {0.0, 1.0}
    assert ft.cluster_members(rows).columns == ["cluster", "language", "log_size", "growth", "volatility_pct"]


def test_zscores_and_pca(features):
    z = ft.zscores(features).toPandas()
    raw = features.toPandas()
    assert z["avg_repo_growth"].std() == pytest.approx(1) and (z[FEATURES[-1]] == 0).all()
    x = raw[list(FEATURES[:4])].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    got = ft.pca_2d(features, FEATURES[:4]).toPandas().set_index("language").loc[raw["language"]]
    assert np.abs(got["pc1"].to_numpy()) == pytest.approx(np.abs(u[:, 0] * s[0]), abs=1e-6)


def test_growth_features_of_one_month(spark):
    df = spark.createDataFrame([("x", "2020-01", 1, 3, 4)], "language string, year_month string, total_bytes long, repo_count long, commit_count long")
    row = ft.growth_features(df).first()
    assert tuple(row)[1:] == (0.0, 0.0, 1.0, 3.0, 4.0)


def test_flows(spark, rows):
    e = spark.createDataFrame(
        [("a", "b", 5, 2, "2016", "2019"), ("b", "a", 3, 1, "2021", "2022"), ("c", "a", 4, 1, "2010", "2012")],
        "from_tech string, to_tech string, migration_count long, years_active long, first_year string, last_year string",
    )
    assert rows(migration.node_flow(e)) == [("a", 5, 7, 2), ("b", 3, 5, 2), ("c", 4, 0, -4)]
    assert rows(migration.net_direction(e)) == [("a", "b", 5, 2), ("c", "a", 4, 4)]
    periods = rows(migration.edges_by_period(e), "from_tech", "period")
    assert periods == [("a", "early"), ("a", "full"), ("a", "mid"), ("b", "full"), ("b", "late"), ("b", "mid"), ("c", "early"), ("c", "full")]
    assert rows(serving.sankey_links(e, 2), "source", "target", "value") == [(0, 1, 5), (2, 0, 4)]
    verdicts = {r.tech: r.verdict for r in migration.win_loss(migration.node_flow(e)).collect()}
    assert verdicts == {"a": "winner", "b": "winner", "c": "loser"}


def test_histogram(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 9, 10, 10]], "x double")
    assert rows(serving.histogram(df, F.col("x"), 5)) == [(0, 0.0, 2), (1, 2.0, 1), (4, 8.0, 3)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert rows(serving.histogram(flat, F.col("x"), 5)) == [(0, 3.0, 2)]


def test_profiles(spark, rows):
    members = spark.createDataFrame(
        [("a", 0, 0.5, 0), ("b", 0, 0.2, 2), ("c", 1, 0.3, 9)], "dev_id string, community_id long, pagerank double, degree long"
    )
    facts = spark.createDataFrame(
        [("a", "o/x"), ("a", "o/y"), ("b", "P/z"), ("b", "q/z"), ("b", "r/z")], "dev_id string, repo_name string"
    )
    orgs = serving.community_orgs(members, facts, 2)
    assert rows(orgs) == [(0, "o, p")]
    labels = {r.community_id: r.label for r in serving.community_profile(members, orgs).collect()}
    assert labels == {0: "C0 (o, p)", 1: "C1 (?)"}
    assert rows(serving.degree_bands(members)) == [(0, 1, 1, 0, 0), (1, 0, 0, 0, 1)]
    summary = serving.size_summary(members).first()
    assert (summary.communities, summary.largest, summary.singletons, summary.median_size) == (2, 2, 1, 1.5)
    assert [r.dev_short for r in serving.bridge_actors(members, 2).collect()] == ["c", "b"]

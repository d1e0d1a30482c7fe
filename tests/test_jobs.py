from __future__ import annotations

import json
import os
from datetime import datetime

import pytest

from adoptrend import jobs
from adoptrend.session import drop_scratch, scratch_path
from adoptrend.sources import log, sinks
from adoptrend.sources.inputs import Inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")
def test_all_jobs(spark):
    base = scratch_path(spark, "jobs")
    t = Inputs(spark, FOLDER)
    raw = {
        "languages": t.languages_flat,
        "commits": t.commits_monthly,
        "migrations": t.migration_signals.replace(
            {"brand#1": "go", "brand#2": "rust", "brand#3": "java", "brand#4": "scala"}, subset=["from_tech", "to_tech"]
        ),
        "developers": t.developer_repos,
    }
    sinks.export_tables(raw, f"{base}/raw")
    jobs.run(spark, list(jobs.STEPS)[2:], base, k=3, series=40, top_actors=40)
    read = lambda name: sinks.read_table(spark, f"{base}/processed/{name}")
    assert read("d1_monthly").columns == ["language", "year_month", "total_bytes", "repo_count", "commit_count"]
    assert read("d1_clusters").select("cluster").distinct().count() == 3
    assert read("d1_cluster_centers").count() == 3
    rows = read("d2_forecasts")
    told = read("d2_forecast_rows")
    assert set(told.columns) >= {"yhat", "lower", "upper", "model", "status"} and told.where("status = 'ok'").count() == rows.count()
    assert rows.where("is_forecast").count() == 24 * rows.select("language").distinct().count() > 0
    nodes = read("d3_nodes")
    assert {r.tech for r in nodes.collect()} <= {"go", "rust", "java", "scala"} and nodes.count() > 2
    assert nodes.columns == ["tech", "out_weight", "in_weight", "net_flow", "pagerank", "betweenness"]
    ranks = read("d4_pagerank")
    assert ranks.columns == ["dev_id", "pagerank", "hub_score", "auth_score", "degree", "total_commits"]
    assert ranks.count() == 40 and abs(ranks.agg({"pagerank": "sum"}).first()[0] - 1) < 1e-9
    members = read("d5_communities")
    assert members.count() == 40 and dict(members.dtypes)["community_id"] == "int"
    assert ranks.where("dev_id like '%ustomer%' or length(dev_id) <> 64").count() == 0
    served = spark.read.json(f"{base}/serving/d4_pagerank")
    assert served.count() == 40 and served.where("length(dev_short) <> 12").count() == 0
    assert spark.read.json(f"{base}/serving/d1_monthly").select("language").distinct().count() <= 20
    assert "incoming" in spark.read.json(f"{base}/serving/d3_nodes").columns
    drop_scratch(spark)
    assert not os.path.exists(base.removeprefix("file:"))


def test_from_log_to_monthly(spark, rows, capsys):
    base = scratch_path(spark, "jobs")
    message = lambda *texts: json.dumps({"commits": [{"message": t} for t in texts]})
    push = lambda month, repo, who, *texts: ("PushEvent", repo, who, datetime(2024, month, 3), message(*texts))
    events = [push(m, "o/a", "Ann", "switch from java to rust", "tidy") for m in range(1, 13)]
    events += [push(2, "o/b", "bob", "move from java to rust"), push(3, "o/b", "renovate[bot]", "x"), push(12, "o/c", "cy", "y")]
    events += [("WatchEvent", "o/a", "Ann", datetime(2024, 1, 5), "{}")]
    schema = "type string, repo_name string, actor_login string, created_at timestamp_ntz, payload string"
    log.write_events(spark.createDataFrame(events, schema), f"{base}/log/events", "created_at")
    labels = [("o/a", " Go ", None), ("o/b", "rust", "2024-02-01T00:00:00Z"), ("o/c", "Markdown", None), ("o/c", "", None)]
    spark.createDataFrame(labels, "repo_name string, language string, created_at string").write.parquet(f"{base}/log/labels")

    jobs.run(spark, jobs.STEPS, base, dry_run=True)
    assert "log/events -> raw/commits" in capsys.readouterr().out
    jobs.run(spark, ["extract", "ingest", "preprocess", "aggregate"], base, months=("202401", "202412"))
    raw = lambda name: sinks.read_table(spark, f"{base}/raw/{name}")
    assert rows(raw("languages").select("repo_name", "language")) == [("o/a", "go"), ("o/b", "rust")]
    assert raw("commits").agg({"commit_count": "sum"}).first()[0] == 15
    assert rows(raw("migrations")) == [("java", "rust", "2024", 13)]
    assert {r.developer_email for r in raw("developers").collect()} == {"ann", "bob", "cy"}
    monthly = sinks.read_table(spark, f"{base}/processed/d1_monthly").collect()
    assert {(r.language, r.commit_count) for r in monthly} == {("go", 1)} and len(monthly) == 12

    jobs.run(spark, ["extract"], base, months=("202402", "202402"))
    assert raw("commits").agg({"commit_count": "sum"}).first()[0] == 2


def test_only_the_months_folders_are_read(spark):
    base = scratch_path(spark, "log")
    days = [(i, datetime(2024, 1 + i % 6, 2)) for i in range(60)]
    log.write_events(spark.createDataFrame(days, "i int, ts timestamp_ntz"), base, "ts")
    part = log.load_events(spark, base, "2024-02", "202403")
    assert sorted({r.i % 6 for r in part.collect()}) == [1, 2] and part.columns == ["i", "ts"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert log.load_events(spark, base).count() == 60

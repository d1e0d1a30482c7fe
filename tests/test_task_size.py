"""What a task holds and how often a step runs must not grow with the rows."""

from __future__ import annotations

import re
from types import SimpleNamespace

from pyspark.sql import functions as F

from adoptrend.operators import levels, temporal
from adoptrend.plans import clusters, forecasting
from adoptrend.session import _written
from adoptrend.sources.inputs import Inputs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_are_bounded(spark):
    Inputs(spark, "/none")
    # larger input gives more tasks, not larger ones (10 GB executors, four tasks each, hold 3.6 GB a task)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_activity_is_counted_by_whole_numbers(spark):
    lines = spark.sql("SELECT * FROM VALUES (1L, timestamp'2000-01-31 23:59:59'), (1L, timestamp'2000-01-01'), (1L, timestamp'2000-02-01'), (2L, NULL), (9L, timestamp'2000-01-01') AS t(l_partkey, l_shipdate)")
    inputs = Inputs(spark, "/none")
    inputs.__dict__["repos"] = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "p_partkey long, repo_name string")
    told = inputs._commits(lines)
    assert sorted(map(tuple, told.collect()), key=repr) == [("a", "2000-01", 2), ("a", "2000-02", 1), ("b", None, 1), ("c", None, 1)]
    assert re.search(r"HashAggregate\(keys=\[l_partkey#\d+L, month#", re.sub(r"_groupingexpression", "month", plan(told)))
    assert "date_format(cast(" in plan(told)  # only what is left gets its label


def test_levels_hold_no_entity_and_group(spark):
    df = spark.createDataFrame([("e", "a", 1, 2), ("e", "a", 2, 3), (None, "b", 1, 7), ("f", None, 1, 1)], "entity string, a string, b int, n long")
    told = levels.distinct_at_levels(df, "entity", ["a", "b"], levels.cube_sets(["a", "b"]), ["n"])
    assert sorted(map(tuple, told.where("grouping_id = 1").collect()), key=repr) == [("a", None, 1, 1, 5), ("b", None, 1, 0, 7), (None, None, 1, 1, 1)]
    # aggregations: facts by (entity, combination), entities, groups; each before and after its exchange
    assert len(re.findall(r"\w*Aggregate\(keys=", plan(told))) <= 6


def test_overlap_reads_its_rows_once(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 5, 9), (1, 7, 7), (2, 1, 9)], "k int, s int, e int")
    found = temporal.overlap_join(df, df, ["k"], ("s", "e"), ("s", "e"), 2)
    assert found.count() == 8 and "ExistingRDD" not in plan(found) and "LocalTableScan" not in plan(found)
    assert len(set(re.findall(r"cut-[0-9a-f]{32}", found._jdf.queryExecution().toString()))) <= 1


def test_monthly_metrics_and_edges_are_computed_once(spark):
    months = [(lang, f"{y}-{m:02d}", 10 * k + m, k + m, 5) for k, lang in enumerate(("x", "y")) for y in range(2000, 2007) for m in range(1, 13)]
    held = spark.createDataFrame(months, "language string, year_month string, total_bytes long, repo_count long, commit_count long")
    once = SimpleNamespace(monthly_table=held)  # there is nothing else to read
    assert clusters.features(once).count() == 2
    assert forecasting.line(once).where(F.col("is_forecast")).count() == 2 * forecasting.EVERY
    inputs = Inputs(spark, "/none")
    inputs.__dict__["migration_signals"] = spark.createDataFrame([("a", "b", "2000", 500)], "from_tech string, to_tech string, year string, migration_count long")
    assert inputs.migration_edges in _written and inputs.migration_edges.count() == 1

"""A choice of the registered queries next to their SQL; ``python -m tests.parity`` runs all of them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tests.parity import compare, oracle

FOLDER = "/root/testdata/sf0.01"
CHOSEN = [
    "monthly_metrics", "mom_growth", "scan_event_range", "scan_hash_sample", "ingest_labels", "json_unnest",
    "mine_pairs", "co_edges", "migration_edges", "edges_by_period", "connected_components", "pagerank_undirected",
    "gapfilled_series", "hw_fixed_params", "growth_features", "describe_actors", "community_orgs", "stream_tumbling",
    "forecast_long", "forecast_check", "clusters_check", "pca_check", "community_flow", "stream_sessions",
    "influential_communities", "betweenness_inverse", "pagerank_converged",
    "asof_labels", "overlapping_work", "cube_levels", "grouping_sets_levels", "sketched_years", "describe_sketched",
    "stream_sessions_deduplicated",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def connection():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", CHOSEN)
def test_agrees_with_sql(spark, connection, name):
    verdict, note = compare(spark, connection, name, FOLDER)
    assert verdict == "ok", note


def test_contract(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == ["language", "year_month", "total_bytes", "repo_count", "commit_count"]
    assert flagship.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())

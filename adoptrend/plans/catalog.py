"""Loads every module that registers queries."""

from __future__ import annotations

from adoptrend.plans import clusters, extraction, forecasting, graphs, rollups, streams, temporal, trending, views  # noqa: F401
from adoptrend.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

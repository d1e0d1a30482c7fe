"""Adoption trends, forecasts and interaction graphs as Spark DataFrame operators."""

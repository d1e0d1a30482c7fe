"""Graph algorithms as rounds of joins and aggregations."""

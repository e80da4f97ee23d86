"""Loads every module that registers queries."""

from vocabweave.plans import catalog, graph_queries, graph_views, scalar_queries, source_queries, table_queries  # noqa: F401

QUERIES = catalog.QUERIES
ORACLES = {name: catalog.with_views(sql, "MATERIALIZED ") for name, sql in catalog.ORACLES.items()}

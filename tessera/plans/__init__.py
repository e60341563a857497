"""The catalogue of queries over the input tables."""

from __future__ import annotations

from . import build_queries, graph_queries, log_queries, pass_queries, reach_queries, round_queries, store_queries, table_queries, text_queries
from .base import Query, together

QUERIES: dict[str, Query]
ORACLE_SQL: dict[str, str]
QUERIES, ORACLE_SQL = together(*(m.CATALOGUE for m in (graph_queries, table_queries, log_queries, pass_queries, text_queries, build_queries, store_queries, reach_queries, round_queries)))

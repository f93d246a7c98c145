"""Registered queries and their DuckDB SQL."""

from . import curation_queries, frame_queries, market_queries, source_queries, stream_queries

_PARTS = (market_queries, frame_queries, curation_queries, source_queries, stream_queries)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLES = {k: v for part in _PARTS for k, v in part.ORACLES.items()}

"""The registered queries and their SQL."""

from __future__ import annotations

from ledgerline.plans import decode_queries, flow_queries, gtid_queries, snapshot_queries, stream_queries

PARTS = (gtid_queries, flow_queries, snapshot_queries, decode_queries, stream_queries)
QUERIES = {name: f for part in PARTS for name, f in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}

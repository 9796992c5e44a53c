"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from tidepool.plans import ingest, lakehouse, orchestrated, retrieval

QUERIES = {}
ORACLE = {}
for _mod in (lakehouse, ingest, retrieval, orchestrated):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)

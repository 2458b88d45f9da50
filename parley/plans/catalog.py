"""All catalogued queries and the SQL that checks them."""

from __future__ import annotations

from parley.plans import catalog_bot, catalog_stream, catalog_tables

_PARTS = (catalog_tables, catalog_stream, catalog_bot)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

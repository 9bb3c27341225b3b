"""Queries over the given tables, each with the SQL that must give the same rows."""

from lakeops.plans import changing, documents, modelling, reading, shaping, summarising, temporal

_PARTS = (reading, shaping, summarising, changing, temporal, documents, modelling)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: text for part in _PARTS for name, text in part.ORACLES.items()}

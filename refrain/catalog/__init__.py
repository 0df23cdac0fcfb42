"""Every query by name, with the SQL text that gives the same result in another engine."""

from __future__ import annotations

from refrain.catalog import explore, features, learning, rows

MODULES = (rows, features, explore, learning)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}

"""All queries of the engine and their SQL."""

from __future__ import annotations

from tessera.queries import batch, catalog, changes, filtered, pages, plans, review, runs

QUERIES: dict = {}
ORACLES: dict = {}
for module in (catalog, pages, plans, filtered, changes, batch, review, runs):
    QUERIES |= module.QUERIES
    ORACLES |= module.ORACLES

"""Queries over the given tables: each module has QUERIES and, with the same keys, ORACLES."""

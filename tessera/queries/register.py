"""Registration of a module's queries."""

from __future__ import annotations

from collections.abc import Callable


def registrar() -> tuple[dict, dict, Callable]:
    """(queries, oracles, decorator); the decorator takes the SQL that gives the same rows."""
    queries: dict = {}
    oracles: dict = {}

    def query(oracle: str | None = None):
        def register(function):
            queries[function.__name__] = function
            if oracle:
                oracles[function.__name__] = oracle
            return function

        return register

    return queries, oracles, query

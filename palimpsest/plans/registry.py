"""All registered queries (importing the modules that register them)."""

from __future__ import annotations


def all_queries():
    from . import queries

    return dict(queries.QUERIES)

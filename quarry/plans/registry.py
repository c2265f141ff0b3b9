"""All registered queries: name -> Spark callable, and name -> DuckDB SQL twin."""

from __future__ import annotations

import importlib

_MODULES = [
    "quarry.plans.star_queries",
    "quarry.plans.text_queries",
    "quarry.plans.mention_queries",
    "quarry.plans.search_queries",
    "quarry.plans.search_batch_queries",
    "quarry.plans.vector_queries",
    "quarry.plans.load_queries",
    "quarry.plans.sink_queries",
]


def _load():
    queries, sql = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        for k in mod.Q:
            if k in queries:
                raise ValueError(f"duplicate query name {k}")
        queries.update(mod.Q)
        sql.update(mod.SQL)
    return queries, sql


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]

"""Named query plans: ``queries()`` and ``oracle_sql()`` for the driver."""

from __future__ import annotations

import importlib

from pulsegraph.plans.registry import REGISTRY, Query

_MODULES = ("q_posts", "q_mentions", "q_graph", "q_sinks", "q_stream")


def _load() -> dict[str, Query]:
    for m in _MODULES:
        importlib.import_module(f"pulsegraph.plans.{m}")
    return REGISTRY


def queries():
    return {n: q.fn for n, q in _load().items()}


def oracle_sql():
    return {n: q.sql for n, q in _load().items() if q.sql is not None}

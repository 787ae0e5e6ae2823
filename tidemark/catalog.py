"""The registry of the synchronisation queries and their SQL."""

from __future__ import annotations

from tidemark.functions import keys
from tidemark.operators import cdc, records, rounds, validation
from tidemark.plans import assign, health, indexes, splits
from tidemark.sources import discovery, segments, sinks, snapshot
from tidemark.streaming import apply, dirty

MODULES = (keys, discovery, snapshot, segments, sinks, cdc, validation, rounds, records, splits, assign, indexes, health, apply, dirty)


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}

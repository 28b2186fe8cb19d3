"""Runnable queries over the given tables."""

from __future__ import annotations

from rankweave.plans import evaluation, features, models, relational, sources  # noqa: F401
from rankweave.plans.catalog import ORACLES, QUERIES, Query


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)

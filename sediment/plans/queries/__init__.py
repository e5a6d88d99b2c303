"""Registered queries: each reads whole tables of a data directory, most with SQL to check against."""

from sediment.plans.queries import (  # noqa: F401  (fills the registry)
    aggregates,
    anomaly,
    audit,
    columns,
    gold,
    joins,
    quality,
    sources,
    streams,
)
from sediment.plans.queries.registry import oracles, runners

__all__ = ["oracles", "runners"]

"""Queries over the given tables, each with its SQL twin where SQL can say it."""

from tidemark.plans import (  # noqa: F401
    audits,
    costs,
    downloads,
    inventory,
    mappers,
    merges,
    notes,
    queues,
    reports,
    scalars,
    streams,
    validation,
)
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

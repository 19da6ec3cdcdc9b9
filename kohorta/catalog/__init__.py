"""Queries on the given tables, each with its SQL where SQL can say it."""

from kohorta.catalog import basics, clinical, events, raw  # noqa: F401

from kohorta.catalog import patients  # noqa: F401  (needs the raw views)
from kohorta.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

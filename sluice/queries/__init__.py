"""Registered queries and their SQL oracles."""

from sluice.queries import dirty, lookup, pivots, sensitive, texts, written
from sluice.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "dirty", "lookup", "pivots", "sensitive", "texts", "written"]

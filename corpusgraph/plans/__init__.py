"""Queries over the given tables: derived corpora, plans and reference SQL."""

from corpusgraph.plans import articles, entities, finding, vault  # noqa: F401
from corpusgraph.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Operators for preparing training data at scale; ``queries`` registers them over the test tables."""

from corpusloom.llm import queries as _queries  # noqa: F401  (registers them)
from corpusloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Operators for training-data pipelines; nothing else in the library imports this package."""

from basketry.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

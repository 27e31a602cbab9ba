"""The registered queries and their checks."""

from basketry.plans import profiles, properties, scoring, tables_and_rules  # noqa: F401  (registers the queries)
from basketry.plans.registry import ORACLES, QUERIES, inputs

__all__ = ["ORACLES", "QUERIES", "inputs"]

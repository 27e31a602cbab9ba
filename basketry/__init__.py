"""Shopping-basket analytics and recommendation on Spark DataFrames."""

from basketry.session import build_session
from basketry.sources.star import BasketTables, load_star

__all__ = ["BasketTables", "build_session", "load_star"]

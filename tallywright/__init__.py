"""Spark-native analytics over text-bearing postings and their tags."""

from tallywright.session import build_session, materialize

__all__ = ["build_session", "materialize"]

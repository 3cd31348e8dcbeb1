"""Operators of a training-data pipeline; nothing else in the library imports them."""

from nightflux.llm.queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

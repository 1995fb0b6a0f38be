"""Steward: typed load, profiling, reconciliation, generation and fraud analytics on PySpark."""

from steward.session import session

__all__ = ["session"]

"""The library's operators bound to the driver's tables, each with its SQL oracle."""

from bindings import analytics, committing, generating, joining, nesting, profiling, reconciling, storing, streaming, summarizing, typing  # noqa: F401
from bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Registered queries: the operators applied to the driver's tables, each with an SQL oracle."""

from . import checks, controls, history, measures, relational, scalars, streams, transport  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

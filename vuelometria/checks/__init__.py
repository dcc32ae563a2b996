"""Registered queries over the test tables and their independent SQL counterparts."""

from . import dashboard, expressions, io, mergeable, models, relational  # noqa: F401  (they fill the registry)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries."""

from . import analytics, integrity, loaders, relational, scalars  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

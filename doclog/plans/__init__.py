"""Queries over the given tables, one per operator, with SQL that checks them."""

from . import batch, streams  # noqa: F401 - importing registers the queries
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

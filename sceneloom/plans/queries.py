"""Queries of the engine's operators, and the SQL that checks them."""

from . import flows, pictures, relations, sequences, texts  # noqa: F401  they register queries
from .base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

"""Queries that bind the operators and plans to the benchmark tables."""

from chartloom.catalogue.base import QUERIES
from chartloom.catalogue import checks, cultures, extraction, histories, joining, profiles, scalars, storage, tables_a, tables_b  # noqa: F401

__all__ = ["QUERIES"]

"""Registered queries with their SQL twins."""

from .linkage import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

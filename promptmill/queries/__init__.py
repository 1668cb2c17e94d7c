"""Named queries: every operator on the given tables, each with the SQL that gives the same rows."""

from . import chat, render, scoring, shapes, streams, text, tokens  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

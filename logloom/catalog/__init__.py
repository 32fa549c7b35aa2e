"""Runnable queries over the standard tables, with the SQL that states their result."""

from logloom.catalog import files, items, learning, logs, streams, tables, texts, vectors
from logloom.catalog.base import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "files",
    "items",
    "learning",
    "logs",
    "streams",
    "tables",
    "texts",
    "vectors",
]

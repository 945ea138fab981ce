"""All registered queries."""

from loreweave.catalog import chat, compare, files, memory, search, streams, training  # noqa: F401
from loreweave.catalog.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]

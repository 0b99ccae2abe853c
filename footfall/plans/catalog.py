"""Import every query module so the registry is complete."""

from __future__ import annotations

from . import core, io, streams  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

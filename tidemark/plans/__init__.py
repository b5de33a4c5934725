"""The registered queries, grouped by area."""

from . import commerce, errors, health, identity, nulls, rollups, sessions, sources, streams, values  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries."""

from pairloom.catalog import compositions, maintenance, relational, research, scalars, sources, windows  # noqa: F401
from pairloom.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

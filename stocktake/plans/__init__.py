"""Query plans over the driver tables: QUERIES (name -> callable) and ORACLES (name -> DuckDB SQL)."""

from . import assign, content, extras, reconcile, scans, signals, stats
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "assign", "content", "extras", "reconcile", "scans", "signals", "stats"]

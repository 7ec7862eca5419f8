"""Registered queries: each a function of a session and a folder, with the same in SQL."""

from fleetledger.queries import kept  # noqa: F401  (registers its queries)
from fleetledger.queries.oracle import ORACLE
from fleetledger.queries.registry import QUERIES

__all__ = ["ORACLE", "QUERIES"]

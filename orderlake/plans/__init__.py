"""Registered queries; importing this package fills the registry."""

from orderlake.plans import changes, control, ingest, live, marts  # noqa: F401
from orderlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries and their SQL."""

from __future__ import annotations

from fleetgauge.plans import dashboard, ingest, lifecycle, monitoring, statistics, stores, streams  # noqa: F401
from fleetgauge.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

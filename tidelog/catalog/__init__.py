"""Every registered query with its check in SQL, collected from the catalog modules."""

from __future__ import annotations

from tidelog.catalog.registry import REGISTRY, SQL
from tidelog.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    detectors,
    joins,
    logs,
    orders,
    patterns,
    records,
    streams,
    windows,
)

__all__ = ["REGISTRY", "SQL"]

"""Every operator as a query over the given tables, with the SQL it must equal."""

from __future__ import annotations

import importlib

from opslog.catalog.base import REGISTRY, Entry

MODULES = [
    "uniques", "gauges", "pairs", "outcomes", "concurrent", "rollups", "dashboards", "ingests", "basics",
    "jobs", "live", "lake_jobs",
]


def load() -> dict[str, Entry]:
    for name in MODULES:
        importlib.import_module(f"opslog.catalog.{name}")
    return dict(REGISTRY)

"""Every operator bound to the given tables, with its SQL twin."""

from __future__ import annotations

import importlib

from tablecraft.plans.registry import QUERIES, SQL

SECTIONS = [
    "sources", "filters", "joins", "aggregates", "windows", "ordering", "sets",
    "functions", "timeseries", "stats", "etl", "hierarchy", "udfs", "streams",
]


def load_all():
    for name in SECTIONS:
        importlib.import_module(f"tablecraft.queries.{name}")
    return QUERIES, SQL

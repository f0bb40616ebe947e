"""All registered queries and their SQL."""

from __future__ import annotations

import importlib

SECTIONS = [
    "scans", "projection", "joins", "aggregates", "ordering", "sorting", "scalars",
    "reshape", "profiling", "encoding", "composites", "neighbours", "models", "evaluation",
    "splits", "streams", "hooks",
]


def all_books():
    for name in SECTIONS:
        yield importlib.import_module(f"featherloom.catalog.{name}").book

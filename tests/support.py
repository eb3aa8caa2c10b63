"""Helpers of the test modules (a module of its own: every folder has a ``conftest``)."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as tuples (optionally of selected columns), sorted."""
    data = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in data.collect()),
                  key=lambda t: [(v is None, v if isinstance(v, (int, float)) else str(v)) for v in t])

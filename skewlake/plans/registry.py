"""All queries of the library, and their SQL."""

from __future__ import annotations

from . import aggregates, ingest, projections, selection, streams  # noqa: F401  they register their queries
from .base import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)

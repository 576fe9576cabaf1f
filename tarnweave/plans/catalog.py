"""All queries of the library and their SQL."""

from __future__ import annotations

from . import canonical, domain, flows, graphs, relational, storage, surface  # noqa: F401
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Queries over the tables, each with the SQL that it must agree with."""

from __future__ import annotations

from lectern.plans import base, documents, layout, papers, reports, schemes, shares, sources, timeline


def queries() -> dict[str, base.Query]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)

"""Plain SQL equivalents of the registered queries, for checking only."""

from __future__ import annotations


def all_oracles() -> dict[str, str]:
    from oracles import analytics_sql, feature_sql, raw_sql

    return {**analytics_sql.ORACLES, **raw_sql.ORACLES, **feature_sql.ORACLES}

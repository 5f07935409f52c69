"""Registered queries and the SQL each is checked against."""

from tallywright.registry import broken_queries, clean_queries, demand_queries, load_queries, order_queries, pay_queries, star_queries, trend_queries, written_queries

_MODULES = (demand_queries, pay_queries, trend_queries, clean_queries, star_queries, broken_queries, written_queries, load_queries, order_queries)


def queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}

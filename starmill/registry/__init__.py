"""Registered queries, each next to the SQL that states its result."""

from starmill.registry import audit, dimensions, facts, history, lifecycle, marts, quality, repairs, staging, stream

_MODULES = (staging, dimensions, facts, marts, history, audit, quality, stream, repairs, lifecycle)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

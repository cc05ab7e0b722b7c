"""The registered queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from rankloom.workload import content, curation, evaluation, files, growing, logs, modes, retrieval, suggestions, vectors

_MODULES = (content, retrieval, vectors, curation, suggestions, evaluation, modes, logs, growing, files)


def queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}

"""Operators for training-data pipelines, with their queries and SQL.

Nothing else in the library imports this package.
"""

from __future__ import annotations


def queries() -> dict:
    from rankloom.llm import workload

    return dict(workload.QUERIES)


def oracle_sql() -> dict[str, str]:
    from rankloom.llm import workload

    return dict(workload.ORACLE)

"""Registered queries: name → callable, and name → oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "status_breakdown"


def query(name: str, sql: str | None = None) -> Callable:
    """Register the decorated callable under name, with its oracle."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


from . import reports  # noqa: E402, F401  (registers)
from . import corpus  # noqa: E402, F401
from . import extraction  # noqa: E402, F401
from . import search  # noqa: E402, F401
from . import batch  # noqa: E402, F401
from . import storage  # noqa: E402, F401

"""The registry of queries: a callable for Spark, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docweave.plans.base import BASE, duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query; ``[relation]`` in its SQL stands for a base relation."""

    def keep(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = re.sub(r"\[(\w+)\]", lambda m: duck(m[1]) if m[1] in BASE else m[0], sql)
        return run

    return keep

"""Registry of queries (Spark side) and oracles (DuckDB SQL side).

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is SQL over the
test tables registered as views.  Both sides alias every column alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from strongroom.suite import (  # noqa: F401
        q_audit,
        q_mart,
        q_profile,
        q_satellite,
        q_snapshot,
        q_staging,
        q_stream,
        q_vault,
    )

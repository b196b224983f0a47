"""Registry of the training-data queries: each a (spark, sf_dir) → DataFrame builder and, where
SQL can express it, the DuckDB text next to it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from cadenza.session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


#: Rows of an Arrow batch: bounds what a Python worker holds of texts at once.
BATCH_ROWS = 1000


def ready(spark) -> str:
    """Prepares a session for the operators and returns the shared folder: the executors can import the package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            ready(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco

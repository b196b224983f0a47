"""Registry of named queries: each is a (spark, sf_dir) → DataFrame builder and,
where SQL can express it, the DuckDB oracle text next to it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            from cadenza.session import ship_package
            ship_package(spark)  # executors import the package for its Python UDFs
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(c) -> Column:
    """Outputs are rounded to 6 digits on both sides of the oracle check, as
    round(x·10⁶)/10⁶ — the same arithmetic on both engines, so equal doubles
    always round equally (a decimal-string rounding can split on ties)."""
    from cadenza.functions.numeric import stable_round
    return stable_round(c, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in cols})

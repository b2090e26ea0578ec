"""Registry of the named queries exposed to the driver: a Spark builder and, where SQL can express it, an oracle.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame in long form with aliased columns; each oracle is a
DuckDB SQL string over the same tables (registered as views by the checker).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Builder], Builder]:
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco

"""Registry of the queries exposed to the driver.

Each registered callable takes ``(spark, sf_dir)`` and returns a DataFrame over
the given tables (or data Spark derived from them). ``sql`` is the DuckDB
oracle over the same tables; ``None`` marks a query with no SQL form (the
driver then checks row counts only).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    name: str
    fn: QueryFn
    sql: str | None


_REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Registered(name, fn, sql)
        return fn

    return deco


def all_queries() -> dict[str, Registered]:
    # Import for the side effect of registration.
    from lakeops.plans import (  # noqa: F401
        q_layout,
        q_streams,
        q_tabular,
        q_text,
        q_versioned,
    )

    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Null induction for the driver tables (they hold no NULL). Same rule on both
# sides: ``case when <key> % m = 0 then null else <col> end``.
def nk(col: str, key: str, m: int) -> Column:
    return F.when(F.col(key) % m == 0, F.lit(None)).otherwise(F.col(col))


def nk_sql(col: str, key: str, m: int) -> str:
    return f"case when {key} % {m} = 0 then null else {col} end"

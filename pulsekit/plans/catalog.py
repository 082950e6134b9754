"""Registry of named queries: Spark builder + independent SQL oracle.

Each builder takes (spark, sf_dir) and returns a DataFrame over the fixture
tables in ``sf_dir``; builders that materialize a shared frame or fetch range
boundaries run jobs while they build.  Doubles are rounded to 6 places (half-even
on the scaled value) on both sides so that summation order cannot change
the compared digits.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.columns import round_half_even
from pulsekit.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``fn`` with the package on the executors first."""
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    return run


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = shipped(fn)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places."""
    return df.select(*[
        round_half_even(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def load_all() -> None:
    # importing the plan modules fills the registry
    from pulsekit.plans import daily, alerts, experiments, reports  # noqa: F401

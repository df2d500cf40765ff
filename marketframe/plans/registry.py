"""Registry core: named queries: a Spark builder and, where SQL can express it, a DuckDB oracle.

``plans.catalog`` imports every query module; ``__spark_entry__.py`` reads the filled registry. Both sides
round the listed double columns to 6 places so that summation order does not change the hash.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketframe.plans.sql_views import with_views

ROUND_DIGITS = 6
# Dashboard time range used by the registered range reports: the whole fixture month.
RANGE_FROM = "2024-01-01 00:00:00"
RANGE_TO = "2024-02-01 00:00:00"


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    ops: str = ""

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        if not self.doubles:
            return df
        return df.select(*[F.round(F.col(c), ROUND_DIGITS).alias(c) if c in self.doubles else F.col(c)
                           for c in df.columns])

    def oracle(self) -> str | None:
        if self.sql is None or not self.doubles:
            return self.sql
        rep = ", ".join(f"round({c}, {ROUND_DIGITS}) AS {c}" for c in self.doubles)
        return f"SELECT * REPLACE ({rep}) FROM (\n{self.sql}\n) AS oracle_q"


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None, doubles=(), ops: str = ""):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, list(doubles), ops)
        return fn
    return deco


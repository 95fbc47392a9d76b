"""Registry of named queries and their oracle SQL, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, with the DuckDB SQL that gives the same rows if there is any."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(x: str, digits: int) -> str:
    """SQL of functions.numeric.round_half_up."""
    return f"(floor(({x} + 2.220446049250313e-16) * 1e{digits} + 0.5) / 1e{digits})"


for _family in ("rates", "months", "jobs", "records", "rules", "texts", "pages", "landing", "readers", "streams"):
    import_module(f"tidemark.plans.{_family}")

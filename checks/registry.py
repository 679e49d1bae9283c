"""Registry of (query, oracle) pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without ``sql`` only its rows can be checked."""
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(value: Column, digits: int = 6) -> Column:
    """Rounded, and without a negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def round_all(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, dates as text; other columns unchanged."""
    def shape(name: str, dtype: str) -> Column:
        if dtype in ("double", "float"):
            return rounded(F.col(name).cast("double"), digits).alias(name)
        if dtype == "date":
            return F.date_format(name, "yyyy-MM-dd").alias(name)
        return F.col(name)

    return df.select(*[shape(n, t) for n, t in df.dtypes])

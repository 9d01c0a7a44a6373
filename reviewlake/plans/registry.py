"""Named queries over the stored tables and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL twin if there is one."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def r8(column: Column | str, digits: int = 8) -> Column:
    """Few enough digits that the order of a sum does not show."""
    return F.round(column, digits)


def rounded(df: DataFrame, *names: str, digits: int = 8) -> DataFrame:
    return df.withColumns({name: r8(name, digits) for name in names})


def day(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def second(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")

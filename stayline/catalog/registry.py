"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.sources.fixtures import duck_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query and its SQL; ``uses`` names the fixtures put in front as table expressions.

    A SQL text starting with a comma continues the list of table expressions.
    """
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = f"{duck_ctes(*uses)}\n{sql.strip()}" if uses else sql.strip()
        return run

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison between engines."""
    def value(f: T.StructField) -> Column:
        return F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")

    return df.select(*[value(f) for f in df.schema.fields])

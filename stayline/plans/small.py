"""Small sides of joins, with their size checked before they are broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

ROW_LIMIT = 10_000


def fetch(df: DataFrame, limit: int = ROW_LIMIT) -> list[Row] | None:
    """The rows of a per-group result, or None when there are more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def settle(df: DataFrame, limit: int = ROW_LIMIT) -> DataFrame:
    """Compute a per-group result once and mark it for broadcast if it has at most ``limit`` rows.

    A larger result is handed back as it was and joins through a shuffle.
    """
    return settled(df, fetch(df, limit))


def settled(df: DataFrame, rows: list[Row] | None) -> DataFrame:
    return df if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def join_groups(df: DataFrame, stats: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group columns back to rows; null groups match each other. No keys: one-row stats."""
    extra = [c for c in stats.columns if c not in by]
    if not by:
        packed = stats.select(F.struct(*extra).alias("_s"))
        return df.withColumn("_s", packed.scalar()).select(*df.columns, *[F.col(f"_s.{c}").alias(c) for c in extra])
    right = stats.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], *extra)
    return df.join(right, same_keys([F.col(b) for b in by], [F.col(f"_by{i}") for i in range(len(by))]), how).select(
        *df.columns, *extra)


def same_keys(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, (x.eqNullSafe(y) for x, y in zip(left, right)))

"""Summaries of columns that merge: distinct values with a stated error, and exact frequent values of huge columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative standard error of ``distinct_estimates``."""
    return 1.04 / math.sqrt(2**lg_k)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """(by, column, rows, non_null, sketch): one sketch for each column and group, a day for one.

    One scan, and what is shuffled is a sketch a task, group and column instead of every distinct value. Write the table once
    a day and unite what a question needs. Values are compared by their text, nulls are none of them; null groups are
    groups. Without rows there is one line a column if ``by`` is empty, none otherwise.
    """
    named = [(f"_v{i}", c) for i, c in enumerate(columns)]
    rows = df.select(*[F.col(f"`{b}`") for b in by], *[F.col(f"`{c}`").cast("string").alias(v) for v, c in named])
    wide = rows.groupBy(*[f"`{b}`" for b in by]).agg(F.count("*").alias("_rows"), *[
        F.struct(F.count(v).alias("non_null"), F.hll_sketch_agg(v, lg_k).alias("sketch")).alias(v) for v, _ in named])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col("_rows").alias("rows"), F.col(f"{v}.non_null").alias("non_null"),
                               F.col(f"{v}.sketch").alias("sketch")) for v, c in named])
    return wide.select(*[F.col(f"`{b}`") for b in by], F.inline(lines))


def distinct_estimates(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column, rows, non_null, n_unique) of any set of sketches of one size, within ``distinct_error``."""
    return sketches.groupBy(*[f"`{b}`" for b in by], "column").agg(
        F.sum("rows").alias("rows"), F.sum("non_null").alias("non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_unique"))


def heavy_values(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """(column, value, n, total) of every value held by at least ``share`` of a column's rows that are not null. Exact.

    A first scan keeps a frequent-items summary a task and column (of hashes, so long texts cost eight bytes) and names
    candidates; a second counts these alone. A summary of M counters is off by at most 3.5/M of the rows and leaves out
    no value above twice that, so M = 8/share names every value asked for, and at most 2/share come before the last of them.
    Candidates are at most 2/share + 1 a column, which bounds the broadcast; ``share`` is 1e-5 at least.

    Values are compared by their text. Ties and repeated rows count as they come; columns without values give no rows.
    """
    if not 1e-5 <= share <= 1:
        raise ValueError("share must lie between 1e-5 and 1")
    tracked, k = math.ceil(8 / share), math.ceil(2 / share) + 1
    named = [(f"_v{i}", c) for i, c in enumerate(columns)]
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(v) for v, c in named])
    hashed = rows.select(*[F.when(F.col(v).isNotNull(), F.xxhash64(v)).alias(v) for v, _ in named])
    first = hashed.agg(*[F.expr(f"approx_top_k({v}, {k}, {tracked}) filter (where {v} is not null)").alias(v) for v, _ in named],
                       *[F.count(v).alias(f"n{v}") for v, _ in named]).first()
    found = [(c, r["item"], first[f"n{v}"]) for v, c in named for r in first[v] or [] if r["item"] is not None]
    names = df.sparkSession.createDataFrame(found, "column string, _hash long, total long")
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(v).alias("value")) for v, c in named])
    long = rows.select(F.inline(pairs)).where(F.col("value").isNotNull()).withColumn("_hash", F.xxhash64("value"))
    counts = long.join(F.broadcast(names), ["column", "_hash"]).groupBy("column", "value").agg(
        F.count("*").alias("n"), F.first("total").alias("total"))
    return counts.where(F.col("n") >= F.lit(float(share)) * F.col("total"))

"""Latency quantiles of a running stream: one mergeable summary for each group and micro-batch, united on reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SUMMARY = 1000


def rank_error(k: int = SUMMARY) -> float:
    """How far the rank of a quantile read from summaries of size k may be off, as a share of all values (99 of 100 reads)."""
    return 2.296 / k**0.9723


def summarize(df: DataFrame, by: Sequence[str], seconds: Column, k: int = SUMMARY) -> DataFrame:
    """(by, messages, measured, total, least, greatest, summary) for each group; tasks send summaries, not values.

    Null and NaN seconds count as messages and are not measured; a group without any has a null summary. Null groups are
    groups of their own.
    """
    s = F.nanvl(seconds.cast("double"), F.lit(None).cast("double"))
    rows = df.select(*by, s.alias("_s"))
    summary = F.kll_sketch_agg_double("_s", k)
    return rows.groupBy(*by).agg(
        F.count("*").alias("messages"), F.count("_s").alias("measured"), F.sum("_s").alias("total"),
        F.min("_s").alias("least"), F.max("_s").alias("greatest"), summary.alias("summary")).withColumn(
        "summary", F.when(F.col("measured") > 0, F.col("summary")))


def record_latency(stream: DataFrame, by: Sequence[str], seconds: Column, path: str, checkpoint: str, k: int = SUMMARY,
                   trigger: dict | None = None) -> StreamingQuery:
    """Write the summaries of each micro-batch to ``<path>/batch_id=<n>``; a batch that is done again replaces its own.

    Without a trigger it drains what is there and ends.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        summarize(batch, by, seconds, k).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """All summaries so far, with ``batch_id``: filter by it for a stretch of the stream."""
    return spark.read.parquet(path)


def latency_quantiles(summaries: DataFrame, by: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """(by, messages, measured, mean, least, greatest, q) over any set of summaries; ``q`` has one value for each share.

    Ranks are within ``rank_error`` of the shares, the other figures are exact up to the order of adding.
    """
    merged = summaries.groupBy(*by).agg(
        F.sum("messages").alias("messages"), F.sum("measured").alias("measured"),
        F.try_divide(F.sum("total"), F.sum("measured")).alias("mean"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double("summary").alias("_summary"))
    wanted = F.array(*[F.lit(float(p)) for p in shares])
    return merged.withColumn("q", F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_double("_summary", wanted))).drop("_summary")

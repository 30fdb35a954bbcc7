"""Micro-batch sinks. A batch that is replayed after a failure replaces its own output instead of adding to it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A sink takes (rows, kind, batch id); kind is "predictions" or "dead_letters".
Sink = Callable[[DataFrame, str, int], None]


def table_sink(path: str, file_format: str = "parquet") -> Sink:
    """``<path>/<kind>/batch_id=<n>``; the batch id is also the number of the count window."""
    def write(rows: DataFrame, kind: str, batch_id: int) -> None:
        rows.write.mode("overwrite").format(file_format).save(f"{path}/{kind}/batch_id={batch_id}")

    return write


def message_sink(options: Mapping[str, Mapping[str, str]], file_format: str = "kafka") -> Sink:
    """(key, value) messages to one topic per kind; task retries and the checkpoint give at-least-once delivery."""
    def write(rows: DataFrame, kind: str, batch_id: int) -> None:
        payload = [c for c in rows.columns if c not in ("key", "value")]
        value = F.col("value") if "value" in rows.columns else F.to_json(
            F.struct(*payload), {"ignoreNullFields": "false"}).alias("value")
        rows.select("key", value).write.format(file_format).options(**options[kind]).save()

    return write


def read_sink(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{kind}")

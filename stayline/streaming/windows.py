"""Windows of N messages in a running stream: keyed state carries an open window from one micro-batch to the next."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stayline import schema as S

STATE = "window_id long, messages long, errors long, first_sequence long, last_sequence long"
LAST = 2**63 - 1  # stands for a sequence that is null: it comes after all others
FULL, IDLE, OPEN = "full", "idle", "open"


def undecodable_text() -> Column:
    """Whether ``value`` is no JSON object; no field is parsed for it."""
    parsed = F.from_json(F.col("value").cast("string"), "_corrupt string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return parsed.isNull() | parsed["_corrupt"].isNotNull()


def count_windows_stream(stream: DataFrame, lane: Column, sequence: Column, failed: Column, size: int = S.WINDOW_SIZE,
                         idle_seconds: float | None = None) -> DataFrame:
    """One row for each window of ``size`` messages of a lane, sent when the window ends (append mode).

    ``lane`` is what keeps an order, a topic's partition for one; ``sequence`` is the order in it and need not be dense.
    ``failed`` marks messages that count as errors. Within a micro-batch a lane's messages are taken by sequence, null
    ones last; a message of a later micro-batch comes after those of earlier ones, whatever its sequence. A window ends with
    its last message (``closed`` = full), or, given ``idle_seconds``, when its lane brought none for that long (idle). With
    idle windows the query runs until it is stopped: Spark goes on to look for them, so a trigger that drains what is there
    does not end; a query without ``idle_seconds`` does. A null lane is a lane of its own; without messages there are none.

    Only (sequence, failed) of a message is shuffled and five numbers a lane are kept. A lane's part of one micro-batch is
    sorted in one task at nine bytes a message: bound it by the source's limit per trigger, and use more lanes for more tasks.
    """
    kind = stream.select(lane.alias("lane")).schema["lane"].dataType
    sent = T.StructType([T.StructField("lane", kind), *[T.StructField(c, T.LongType()) for c in (
        "window_id", "messages", "errors", "first_sequence", "last_sequence")], T.StructField("closed", T.StringType())])
    idle_ms = None if idle_seconds is None else int(idle_seconds * 1000)

    def count(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, held, wrong, first, last = state.get if state.exists else (0, 0, 0, None, None)
        ended = []
        if state.hasTimedOut:
            if held:
                ended.append((key[0], number, held, wrong, first, last, IDLE))
            state.update((number + (held > 0), 0, 0, None, None))
        else:
            parts = [(f["sequence"].to_numpy(np.int64), f["failed"].to_numpy(bool)) for f in frames]
            order, bad = (np.concatenate(p) for p in zip(*parts))
            by = np.argsort(order, kind="stable")
            order, bad = order[by], bad[by]
            total = np.concatenate([[0], np.cumsum(bad)])
            at = 0
            while at < len(order):
                to = min(len(order), at + size - held)
                first = int(order[at]) if held == 0 else first
                last, held, wrong = int(order[to - 1]), held + to - at, wrong + int(total[to] - total[at])
                at = to
                if held == size:
                    ended.append((key[0], number, held, wrong, first, last, FULL))
                    number, held, wrong, first, last = number + 1, 0, 0, None, None
            state.update((number, held, wrong, first, last))
            if idle_ms is not None and held:
                state.setTimeoutDuration(idle_ms)
        if ended:
            frame = pd.DataFrame(ended, columns=[f.name for f in sent.fields])
            yield frame.astype({c: "Int64" for c in frame.columns[1:6]})

    slim = stream.select(lane.alias("lane"), F.coalesce(sequence.cast("long"), F.lit(LAST)).alias("sequence"),
                         F.coalesce(failed, F.lit(True)).alias("failed"))
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return counted(slim.groupBy("lane").applyInPandasWithState(count, sent, STATE, "append", timeout))


def counted(windows: DataFrame) -> DataFrame:
    return windows.select("lane", "window_id", "messages", (F.col("messages") - F.col("errors")).alias("predictions"), "errors",
                          *[F.nullif(F.col(c), F.lit(LAST)).alias(c) for c in ("first_sequence", "last_sequence")], "closed")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows that have messages and have not ended, as the last finished micro-batch left them."""
    state = spark.read.format("statestore").load(checkpoint)
    held = state.select(F.col("key.lane").alias("lane"), "value.groupState.*")
    return counted(held.where("messages > 0").withColumn("closed", F.lit(OPEN)))

"""Continuous scoring: decode, validate, score and publish each micro-batch as a table."""

from __future__ import annotations

import builtins
import time
from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark import StorageLevel
from pyspark.errors import (
    AnalysisException,
    ArithmeticException,
    ArrayIndexOutOfBoundsException,
    DateTimeException,
    IllegalArgumentException,
    NumberFormatException,
    PySparkException,
    PythonException,
    SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stayline import schema as S
from stayline.operators.scoring import envelope, positive_probability, predictions
from stayline.streaming.messages import STAGE_PREDICT, UNLISTED, dead_letter, route
from stayline.streaming.sinks import Sink

# Adds a score column: a scorecard, or a fitted pipeline followed by ``score_with_model``.
Scorer = Callable[[DataFrame], DataFrame]


def score_with_model(model, df: DataFrame) -> DataFrame:
    """``score`` from a fitted classifier pipeline."""
    return model.transform(df).withColumn("score", positive_probability())


LETTER = ["key", "original_message", "error", "stage", "failed_at"]


def split_scored(routed: DataFrame, scorer: Scorer, processed_ts: Column) -> tuple[DataFrame, DataFrame]:
    """(predictions, dead letters) of routed messages. Every message ends up in exactly one of them: a row that gets no
    score is a dead letter of the prediction stage."""
    good = routed.where(F.col("error").isNull()).drop("error", "stage", "failed_at")
    scored = scorer(good.withColumns({"message_ts": F.col("event_ts"), "message_text": F.col("original_message")})
                    .drop("original_message"))
    # the explode keeps the filters on the score above the filter on errors: merged, rows in error would be scored
    scored = scored.select(*[c for c in scored.columns if c != "score"], F.explode(F.array("score")).alias("score"))
    known = F.col("score").isNotNull() & ~F.isnan("score")
    extra = ["message_ts", *[c for c in routed.columns if c == UNLISTED]]
    rows = predictions(scored.where(known).withColumn(S.KEY, F.coalesce(S.KEY, "key")).select(S.KEY, "score", *extra), extra=extra)
    unscored = scored.where(~F.coalesce(known, F.lit(False))).select("key", *dead_letter(
        "message_text", F.lit("the model gave no score"), F.lit(STAGE_PREDICT), processed_ts))
    bad = routed.where(F.col("error").isNotNull()).select(*LETTER)
    carried = F.parse_json(UNLISTED) if UNLISTED in extra else None
    return envelope(rows, F.col("message_ts"), processed_ts, unlisted=carried), bad.unionByName(unscored.select(*LETTER))


# What an expression or a Python function raises on a row; a failed job of any other kind says nothing about its rows.
RAISED = (AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException,
          NumberFormatException, PythonException, SparkRuntimeException)


def scorer_failed(problem: Exception) -> bool:
    """Whether the scorer raised; otherwise Spark, a disk or the network failed, and the batch is to be done again."""
    if isinstance(problem, PythonException):  # unindented lines of the trace name what was raised in the worker
        kinds = [getattr(builtins, line.split(":")[0].strip(), None) for line in str(problem).splitlines()]
        return not any(isinstance(k, type) and issubclass(k, (OSError, MemoryError)) for k in kinds)
    if isinstance(problem, RAISED):
        return True
    if isinstance(problem, (Py4JError, PySparkException)):  # a JVM function of the scorer, a fitted stage for one
        return "[FAILED_EXECUTE_UDF" in str(problem)
    return not isinstance(problem, (OSError, MemoryError))


def reason_of(problem: Exception) -> str:
    return "prediction failed: " + (str(problem).strip().splitlines() or [type(problem).__name__])[0]


def message_hash() -> Column:
    return F.xxhash64("key", "original_message")


def mark_failing(routed: DataFrame, scorer: Scorer, processed_ts: Column) -> DataFrame:
    """The routed messages with an error for those on which the scorer raises. Other failures are raised here.

    Halves of the messages, by their hash, are scored until only single ones fail, which takes about two short jobs for
    each failing message and each binary digit of the number of messages. Equal messages fail together.
    """
    def marked(by: DataFrame, reason: Column) -> DataFrame:
        failed = F.col("error").isNull() & reason.isNotNull()
        return by.select(*[{"error": F.coalesce("error", reason), "stage": F.when(failed, STAGE_PREDICT).otherwise(F.col("stage")),
                            "failed_at": F.when(failed, processed_ts).otherwise(F.col("failed_at"))}.get(c, F.col(c)).alias(c)
                           for c in routed.columns])

    good = routed.where(F.col("error").isNull())
    failing, parts = [], [(0, 0)]
    while parts:
        bits, tail = parts.pop()
        part = good.where(message_hash().bitwiseAND(F.lit((1 << bits) - 1)) == tail)
        try:
            scored, _ = split_scored(part, scorer, processed_ts)
        except Exception as problem:  # it cannot be applied, whatever the rows
            if not scorer_failed(problem):
                raise
            return marked(routed, F.lit(reason_of(problem)))
        try:
            scored.write.format("noop").mode("overwrite").save()
        except Exception as problem:
            if not scorer_failed(problem):
                raise
            ends = part.agg(F.min(message_hash()).alias("low"), F.max(message_hash()).alias("high")).first()
            if ends.low is None:
                raise  # fails without rows: no message is to blame
            if ends.low == ends.high or bits == 62:
                failing.append((ends.low, ends.high, reason_of(problem)))
            else:
                parts += [(bits + 1, tail), (bits + 1, tail | (1 << bits))]
    reasons = {h: reason for low, high, reason in failing for h in (low, high)}
    if not reasons:
        return routed
    found = routed.sparkSession.createDataFrame(list(reasons.items()), "_hash long, _reason string")
    return marked(routed.join(F.broadcast(found), message_hash() == F.col("_hash"), "left"), F.col("_reason"))


def score_messages(messages: DataFrame, schema: T.StructType, numeric: Sequence[str], scorer: Scorer,
                   processed_ts: Column, fill: Mapping[str, object] | None = None,
                   unlisted: bool = False) -> tuple[DataFrame, DataFrame]:
    """(predictions, dead letters) of a table of messages; ``fill`` replaces blank or absent fields before scoring, and
    ``unlisted`` carries the fields that the schema does not name into the predictions' field of that name."""
    return split_scored(route(messages, schema, list(numeric), processed_ts, fill, unlisted), scorer, processed_ts)


def score_stream(stream: DataFrame, schema: T.StructType, numeric: Sequence[str], scorer: Scorer, sink: Sink, checkpoint: str,
                 clock: Callable[[], Column] = F.current_timestamp, trigger: dict | None = None,
                 fill: Mapping[str, object] | None = None, unlisted: bool = False) -> StreamingQuery:
    """Start scoring a (key, value) stream. Without a trigger it drains what is there and ends.

    Messages on which the scorer raises become dead letters, the others are scored. When a job fails for another reason,
    the batch fails and is done again on restart.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        now = clock()
        # Both sides read the parsed batch: keep it instead of reading and parsing the source twice.
        kept = [route(batch, schema, list(numeric), now, fill, unlisted).persist(StorageLevel.MEMORY_AND_DISK)]

        def scored(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
            good, bad = split_scored(routed, scorer, now)
            kept.append(good.persist(StorageLevel.MEMORY_AND_DISK))
            good.count()  # a scorer that fails does so here, before anything is published
            return good, bad

        try:
            try:
                good, bad = scored(kept[0])
            except Exception as problem:
                if not scorer_failed(problem):
                    raise
                kept.append(mark_failing(kept[0], scorer, now).persist(StorageLevel.MEMORY_AND_DISK))
                if kept[-1].where(F.col("error").isNull()).isEmpty():  # nothing is left to score
                    good, bad = None, kept[-1].select(*LETTER)
                else:
                    good, bad = scored(kept[-1])
            if good is not None:
                sink(good, "predictions", batch_id)
            sink(bad, "dead_letters", batch_id)
        finally:
            for frame in kept:
                frame.unpersist()

    return (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def dedup_stream(stream: DataFrame, event_ts: str, delay: str, keys: Sequence[str] = (S.KEY,)) -> DataFrame:
    """Drop replays of (keys, event time) that arrive within the delay."""
    timed = stream.withColumn(event_ts, F.col(event_ts).cast("timestamp")).withWatermark(event_ts, delay)
    return timed.dropDuplicatesWithinWatermark([*keys, event_ts])


def run_for(query: StreamingQuery, seconds: float) -> bool:
    """Let a query run for a while, then stop it; True when it had ended by itself. Unfinished batches are redone on restart."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)


def run_windows(query: StreamingQuery, windows: int, poll: float = 0.2, timeout: float | None = None) -> int:
    """Stop after a number of finished micro-batches; returns how many were finished.

    Fewer than asked for only when the query ended by itself. With a ``timeout`` in seconds, running into it stops the
    query and raises.
    """
    deadline = None if timeout is None else time.time() + timeout
    done = 0
    while True:
        last = query.lastProgress
        done = last["batchId"] + 1 if last else 0
        if done >= windows or not query.isActive:
            break
        if deadline is not None and time.time() >= deadline:
            query.stop()
            raise TimeoutError(f"{done} of {windows} windows were finished in {timeout} seconds")
        time.sleep(poll)
    if query.isActive:
        query.stop()
    return done

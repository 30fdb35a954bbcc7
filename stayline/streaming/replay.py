"""Replaying a table as messages in bounded chunks, with restart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stayline import schema as S
from stayline.sources.tables import encode_json, read_stream
from stayline.streaming.sinks import Sink


def write_chunks(df: DataFrame, path: str, rows_per_file: int) -> None:
    """Parquet files of bounded size; a replay sends whole files."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)


def replay(spark: SparkSession, path: str, schema: T.StructType, key: str, sink: Sink, checkpoint: str,
           event_ts: Column | None = None, files_per_trigger: int = 1) -> StreamingQuery:
    """Send the files of a table as messages, one chunk per micro-batch.

    The checkpoint remembers which files were sent: a restart goes on after the last finished chunk, and a finished
    replay sends nothing again.
    """
    stream = read_stream(spark, "parquet", {"maxFilesPerTrigger": str(files_per_trigger)}, schema, path)

    def each(batch: DataFrame, batch_id: int) -> None:
        sink(encode_json(batch, key, event_ts), "messages", batch_id)

    return (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stamp() -> Column:
    """Event time of messages sent now."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def subscriber_messages(df: DataFrame, event_ts: Column) -> DataFrame:
    """Subscriber rows as messages; the target stays behind."""
    return encode_json(df.drop(S.TARGET), S.KEY, event_ts)

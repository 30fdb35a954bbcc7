"""Reading and writing tables and messages. Formats and options are parameters; paths are any Hadoop URI."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.functions.scalars import poisson_count, run_stamp, unit_draw

CORRUPT = "_corrupt_record"


def read_subscribers(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header and a declared schema; broken lines are kept in ``_corrupt_record``. A missing path raises."""
    declared = schema or S.subscriber_schema()
    with_corrupt = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(with_corrupt).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_csv(df: DataFrame, path: str) -> None:
    """Quoted so that blanks, empty text and nulls come back as they were."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("emptyValue", "")
     .option("nullValue", "\\N").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("nullValue", "\\N").option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def write_predictions(df: DataFrame, path: str, run_time: Column, file_format: str = "parquet") -> None:
    """Append one run to the predictions table, partitioned by its stamp. The run time is given by the caller."""
    (df.withColumn("run_id", run_stamp(run_time)).write.mode("append").partitionBy("run_id").format(file_format)
     .save(path))


def kafka_source_options(servers: str, topic: str, per_trigger: int | None) -> dict[str, str]:
    """Subscribe from the earliest offset; progress lives in the checkpoint, not in a consumer group.

    ``per_trigger`` bounds a micro-batch (the window size for count windows); None reads all there is.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    return options if per_trigger is None else {**options, "maxOffsetsPerTrigger": str(per_trigger)}


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "3"}


def read_stream(spark: SparkSession, file_format: str, options: Mapping[str, str], schema: T.StructType | None = None,
                path: str | None = None) -> DataFrame:
    """A stream from Kafka or from files. Kafka brings its own schema, files need one."""
    reader = spark.readStream.format(file_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def encode_json(df: DataFrame, key: str, event_ts: Column | None = None) -> DataFrame:
    """Rows to (key, value) messages. NaN becomes null and nulls stay visible in the text."""
    def clean(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        return c.alias(field.name)

    fields = [clean(f) for f in df.schema.fields]
    if event_ts is not None:
        fields.append(event_ts.alias("event_ts"))
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))


def sample_messages(df: DataFrame, key: str, fraction: float, event_ts: Column, seed: int = S.SEED) -> DataFrame:
    """Rows drawn with replacement, as messages: a row may be sent more than once.

    Each row is sent a Poisson number of times (mean ``fraction``), read off a draw that follows from key and seed.
    """
    times = F.array_repeat(F.lit(0), poisson_count(unit_draw(key, seed), fraction))
    return encode_json(df.withColumn("_time", F.explode(times)).drop("_time"), key, event_ts)

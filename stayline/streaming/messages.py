"""Decoding, validating and windowing keyed JSON messages. The same code serves tables and streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.functions.scalars import iso_timestamp, to_number
from stayline.operators.clean import align_schema, validate_rows

CORRUPT, TEXT, UNLISTED = "_corrupt", "_text", "_unlisted"
STAGE_DECODE, STAGE_PREDICT = "decode", "prediction"


def parse(df: DataFrame, schema: T.StructType, text: bool = False) -> DataFrame:
    """Adds struct ``v`` with the fields of the schema, and ``v._corrupt``, the text of a value that is no JSON object.

    Fields are read as text and then converted, so ``5``, ``"5"`` and ``5.0`` are the same number whatever the schema's
    type; text that is no number of that type is null. With ``text`` the struct ``v._text`` holds the fields as they came. The
    one-element explode keeps later filters above the parse: pushed below it they would parse the text again.
    """
    as_text = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields],
                            T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), as_text,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    raw = df.select("*", F.explode(F.array(parsed)).alias("_raw"))
    fields = [_converted(F.col(f"_raw.`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
    came = [F.struct(*[F.col(f"_raw.`{f.name}`").alias(f.name) for f in schema.fields]).alias(TEXT)] if text else []
    v = F.when(F.col("_raw").isNotNull(), F.struct(*fields, F.col(f"_raw.{CORRUPT}").alias(CORRUPT), *came))
    return raw.withColumn("v", v).drop("_raw")


def _converted(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        number = to_number(text)
        return F.when(number == F.floor(number), number.try_cast(kind))
    if isinstance(kind, T.NumericType):
        return to_number(text).try_cast(kind)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def unlisted_fields(value: Column | str, schema: T.StructType) -> Column:
    """The fields of a JSON object that the schema does not name, as a JSON object again; ``{}`` when it names all.

    Values keep their type (``5`` and ``"5"`` stay apart), whatever they are: numbers are written in their shortest form, the
    fields of an object inside them by name. Of a repeated field the last one counts. Null for what is no JSON object, and
    for an object with a repeated field inside one of its values.
    """
    value = F.col(value) if isinstance(value, str) else value
    fields = F.from_json(value.cast("string"), "map<string,variant>")
    rest = F.map_filter(fields, lambda k, _: ~k.isin([f.name for f in schema.fields]))
    names = F.map_keys(rest)
    last = F.map_from_entries(F.filter(F.map_entries(rest), lambda e, i: ~F.array_contains(
        F.slice(names, i + 2, F.size(names)), e["key"])))
    return F.to_json(F.when(F.size(names) == F.size(F.array_distinct(names)), rest).otherwise(last))


def is_corrupt() -> Column:
    return F.col("v").isNull() | F.col(f"v.{CORRUPT}").isNotNull()


def no_object(value: Column | str) -> Column:
    """Whether a value is no JSON object, without reading its fields: the same values as ``is_corrupt`` after ``parse``."""
    value = F.col(value) if isinstance(value, str) else value
    read = F.from_json(value.cast("string"), T.StructType([T.StructField(CORRUPT, T.StringType())]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return F.coalesce(read[CORRUPT].isNotNull() | read.isNull(), F.lit(True))


def decode(df: DataFrame, schema: T.StructType, ingest_ts: Column | None = None) -> DataFrame:
    """Good messages as columns. A missing key falls back to the customer id, a missing event time to the ingest time."""
    good = parse(df, schema).where(~is_corrupt())
    rest = [f.name for f in schema.fields if f.name not in (S.KEY, "event_ts")]
    event_ts = F.col("v.event_ts") if ingest_ts is None else F.coalesce("v.event_ts", iso_timestamp(ingest_ts))
    passed = [c for c in df.columns if c not in ("key", "value")]
    return good.select(*passed, F.coalesce(F.col("key").cast("string"), F.col(f"v.{S.KEY}")).alias("key"),
                       f"v.{S.KEY}", event_ts.alias("event_ts"), *[f"v.{c}" for c in rest])


def dead_letter(original: Column | str, error: Column, stage: Column, failed_at: Column) -> list[Column]:
    original = F.col(original) if isinstance(original, str) else original
    return [original.alias("original_message"), error.alias("error"), stage.alias("stage"), failed_at.alias("failed_at")]


def undecodable(df: DataFrame, schema: T.StructType, failed_at: Column) -> DataFrame:
    """Dead letters of values that ``decode`` leaves out, told without reading the fields of the schema; a missing key is no
    reason to drop one."""
    passed = [c for c in df.columns if c not in ("key", "value")]
    return df.where(no_object("value")).select(
        *passed, F.col("key").cast("string").alias("key"),
        *dead_letter(F.col("value").cast("string"), F.lit("value is not valid JSON"), F.lit(STAGE_DECODE), failed_at))


def route(df: DataFrame, schema: T.StructType, numeric: list[str], failed_at: Column,
          fill: Mapping[str, object] | None = None, unlisted: bool = False) -> DataFrame:
    """Every message once, with ``error`` and ``stage`` null when it can be scored. One pass, no second parse.

    ``fill`` gives the value of a field that is absent, null or blank; it is filled in before numbers are checked. Text
    that is there and is no number stays an error. ``unlisted`` adds ``_unlisted``, see ``unlisted_fields``.
    """
    parsed = parse(df, schema, text=bool(fill))
    carried = [unlisted_fields("value", schema).alias(UNLISTED)] if unlisted else []

    def field(f: T.StructField) -> Column:
        value = F.col(f"v.{f.name}")
        if fill and f.name in fill:
            empty = F.trim(F.coalesce(F.col(f"v.{TEXT}.{f.name}"), F.lit(""))) == ""
            value = F.when(empty, F.lit(fill[f.name]).cast(f.dataType)).otherwise(value)
        return value.alias(f.name)

    flat = parsed.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("original_message"),
                         is_corrupt().alias("_bad"), *carried, *[field(f) for f in schema.fields])
    checked = validate_rows(flat, [f.name for f in schema.fields], numeric, "_invalid")
    return (checked.withColumn("error", F.when(F.col("_bad"), "value is not valid JSON").otherwise(F.col("_invalid")))
            .withColumn("stage", F.when(F.col("_bad"), STAGE_DECODE).when(F.col("_invalid").isNotNull(), STAGE_PREDICT))
            .withColumn("failed_at", F.when(F.col("error").isNotNull(), failed_at))
            .withColumn("key", F.coalesce("key", S.KEY)).drop("_bad", "_invalid"))


def count_window(sequence: Column | str, size: int = S.WINDOW_SIZE) -> Column:
    """Window number of a dense 0-based sequence (an offset): no ordering of rows is needed."""
    seq = F.col(sequence) if isinstance(sequence, str) else sequence
    return F.floor(seq / size).cast("long")


def window_counts(df: DataFrame, schema: T.StructType, sequence: str, size: int = S.WINDOW_SIZE) -> DataFrame:
    """Messages, predictions and errors per count window; no field of the schema is read for that."""
    counts = df.groupBy(count_window(sequence, size).alias("window_id")).agg(
        F.count("*").alias("messages"), F.count_if(no_object("value")).alias("errors"))
    return counts.select("window_id", "messages", (F.col("messages") - F.col("errors")).alias("predictions"), "errors")


def batch_summary(windows: DataFrame, gate: float = S.SUCCESS_GATE) -> DataFrame:
    """Totals over windows, success percentage and whether it reaches the gate."""
    rate = F.try_divide(F.sum("predictions") * 100.0, F.sum("messages"))
    return windows.agg(F.count("*").alias("windows"), F.sum("messages").alias("messages"),
                       F.sum("predictions").alias("predictions"), F.sum("errors").alias("errors"),
                       rate.alias("success_pct"), (rate >= gate).alias("passed"))


def latency(df: DataFrame, event_ts: str, processed_ts: str) -> Column:
    """Seconds between event and processing, microsecond exact."""
    return (F.unix_micros(F.col(processed_ts).cast("timestamp")) - F.unix_micros(F.col(event_ts).cast("timestamp"))) / 1e6


def drop_replays(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key set on a table; a stream uses a watermark, see ``scoring.dedup_stream``."""
    return df.dropDuplicates(keys)


def as_subscribers(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fill in absent columns as nulls and coerce types."""
    return align_schema(df, schema)

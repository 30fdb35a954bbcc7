"""Queries that run as streams over the event files and read back what the sink holds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.catalog.cleaning import edge_time
from stayline.catalog.registry import query, rounded
from stayline.functions.scalars import to_number
from stayline.operators.scoring import Scorecard
from stayline.plans.durable import work_path
from stayline.plans.small import join_groups, settle
from stayline.sources.fixtures import messages_from_events, subscribers, table
from stayline.sources.tables import read_stream
from stayline.streaming.latency import latency_quantiles, read_summaries, record_latency
from stayline.streaming.progress import ProgressLog
from stayline.streaming.scoring import dedup_stream, score_messages, score_stream
from stayline.streaming.sinks import read_sink, table_sink
from stayline.streaming.windows import count_windows_stream, open_windows, undecodable_text

# Fixed scorecard over the event value
CARD = Scorecard(-1.0, {"value": 0.02})


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, schema, f"{sf}/events*.parquet")


def message_stream(spark, sf):
    return messages_from_events(event_stream(spark, sf)).drop("event_id")


def rounded_score(df):
    return CARD.score(df).withColumn("score", F.round("score", 6))


def finished(handle):
    handle.awaitTermination()
    return handle


@query("stream_scan", "select event_id, user_id, event_type, value from events")
def stream_scan(spark, sf):
    out = work_path(spark, "scan")
    finished(event_stream(spark, sf).select("event_id", "user_id", "event_type", "value").writeStream.format("parquet")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows"))
    return spark.read.parquet(f"{out}/rows")


@query("stream_score", """, v as (select coalesce(key, json_extract_string(value, '$.customerID')) as key,
  json_extract_string(value, '$.customerID') as customer, json_extract_string(value, '$.event_ts') as event_ts,
  round(1.0 / (1.0 + exp(-(-1.0 + cast(json_extract(value, '$.value') as double) * 0.02))), 6) as score from messages where json_valid(value))
select 'prediction' as kind, customer as customer, score as churn_probability, case when score >= 0.5 then 'Yes' else 'No' end as prediction,
  event_ts from v
union all select 'dead letter', key, null, 'value is not valid JSON', 'decode' from messages where not json_valid(value)""", ("messages",))
def stream_score(spark, sf):
    out = work_path(spark, "score")
    finished(score_stream(message_stream(spark, sf), S.event_schema(), ["value"], rounded_score, table_sink(out),
                          f"{out}/checkpoint", edge_time))
    sent = read_sink(spark, out, "predictions").withColumn("v", F.from_json(
        "value", "customerID string, churn_probability double, prediction string, event_ts string"))
    letters = read_sink(spark, out, "dead_letters")
    return sent.select(F.lit("prediction").alias("kind"), F.col("v.customerID").alias("customer"), "v.churn_probability",
                       "v.prediction", "v.event_ts").unionByName(
        letters.select(F.lit("dead letter").alias("kind"), F.col("key").alias("customer"),
                       F.lit(None).cast("double").alias("churn_probability"), F.col("error").alias("prediction"),
                       F.col("stage").alias("event_ts")))


@query("stream_progress", "select cast(0 as bigint) as batch_id, count(*) as input_rows from events")
def stream_progress(spark, sf):
    out = work_path(spark, "progress")
    log = ProgressLog(spark, f"{out}/progress")
    spark.streams.addListener(log)
    handle = finished(event_stream(spark, sf).select("event_id").writeStream.format("parquet")
                      .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows"))
    log.wait_for(handle)
    spark.streams.removeListener(log)
    return log.table().where("input_rows > 0").select("batch_id", "input_rows")


@query("stream_dedup", "select distinct user_id, event_type, date_trunc('day', ts) as event_day from events")
def stream_dedup(spark, sf):
    """Replays within the watermark delay are dropped; the delay spans the whole table here, so all of them are."""
    out = work_path(spark, "dedup")
    daily = event_stream(spark, sf).select("user_id", "event_type", F.date_trunc("day", "ts").alias("event_day"))
    finished(dedup_stream(daily, "event_day", "3650 days", ["user_id", "event_type"]).writeStream.format("parquet")
             .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start(f"{out}/rows"))
    return spark.read.parquet(f"{out}/rows").withColumn("event_day", F.col("event_day").cast("timestamp_ntz"))


SUBSCRIBER_CARD = Scorecard(1.0, {"tenure": -0.05, "MonthlyCharges": 0.01, "TotalCharges": 0.001})


def subscriber_messages(spark, sf):
    """Subscriber messages with quoted, blank, absent and broken fields, by the remainder of the key."""
    sub = subscribers(spark, sf).where("tenure is not null and MonthlyCharges is not null")
    k = F.col(S.KEY).cast("long")
    total = (F.when(k % 7 == 1, "").when(k % 7 == 2, "  ").when(k % 7 == 3, "n/a")
             .otherwise(F.col("TotalCharges")))
    tenure = F.when(k % 5 == 0, F.concat(F.col("tenure").cast("string"), F.lit(".0"))).otherwise(F.col("tenure").cast("string"))
    body = F.to_json(F.struct(S.KEY, tenure.alias("tenure"), "MonthlyCharges",
                              F.when(k % 7 != 4, total).alias("TotalCharges")))
    return sub.select(F.col(S.KEY).alias("key"), F.when(k % 11 == 0, F.lit("{cut")).otherwise(body).alias("value"))


@query("stream_score_subscribers", """, m as (select customerID, cast(customerID as bigint) k, tenure, MonthlyCharges, trim(TotalCharges) t
  from subscribers where tenure is not null and MonthlyCharges is not null),
f as (select *, case when k % 7 = 3 then null when k % 7 in (1, 2, 4) or t = '' then 0.0 else try_cast(t as double) end total from m)
select customerID as customer, case when k % 11 <> 0 and total is not null then
    round(1.0 / (1.0 + exp(-(1.0 - 0.05 * tenure + 0.01 * MonthlyCharges + 0.001 * total))), 6) end as score,
  case when k % 11 = 0 then 'value is not valid JSON' when total is null then 'TotalCharges is not numeric' end as error from f""",
       ("subscribers",))
def stream_score_subscribers(spark, sf):
    """Blank and absent total charges count as 0 and are scored; text that is no number and cut messages are dead letters."""
    out = work_path(spark, "subscribers")
    subscriber_messages(spark, sf).write.parquet(f"{out}/in")
    feed = read_stream(spark, "parquet", {}, spark.read.parquet(f"{out}/in").schema, f"{out}/in")
    kind = T.StructType([S.subscriber_schema()[c] if c != "TotalCharges" else T.StructField(c, T.StringType())
                         for c in (S.KEY, "tenure", "MonthlyCharges", "TotalCharges")] + [T.StructField("event_ts", T.StringType())])
    finished(score_stream(feed, kind, ["tenure", "MonthlyCharges", "TotalCharges"], scored_subscribers, table_sink(out),
                          f"{out}/checkpoint", edge_time, fill={"TotalCharges": "0"}))
    sent = read_sink(spark, out, "predictions").select(
        F.col("key").alias("customer"), F.get_json_object("value", "$.churn_probability").cast("double").alias("score"),
        F.lit(None).cast("string").alias("error"))
    return sent.unionByName(read_sink(spark, out, "dead_letters").select(
        F.col("key").alias("customer"), F.lit(None).cast("double").alias("score"), "error"))


def scored_subscribers(df):
    numbers = df.withColumn("TotalCharges", to_number("TotalCharges"))
    return SUBSCRIBER_CARD.score(numbers).withColumn("score", F.round("score", 6))


@query("stream_count_windows", """, o as (select e.user_id % 8 as lane, event_id, json_valid(messages.value) as good,
  row_number() over (partition by e.user_id % 8 order by event_id) - 1 as n from messages join events e using (event_id))
select lane, n // 100 as window_id, count(*) as messages, count(*) filter (good) as predictions, count(*) filter (not good) as errors,
  min(event_id) as first_sequence, max(event_id) as last_sequence, case when count(*) = 100 then 'full' else 'open' end as closed
from o group by 1, 2""", ("messages",))
def stream_count_windows(spark, sf):
    """The feed comes in three parts, with a restart before each: windows go on across them."""
    out = work_path(spark, "windows")
    events = table(spark, sf, "events")
    feed = messages_from_events(events, (F.col("user_id") % 8).alias("lane"))
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = (high - low) // 3 + 1
    for part in range(3):
        cut = F.col("event_id").between(low + part * step, low + (part + 1) * step - 1)
        feed.where(cut).write.mode("append").parquet(f"{out}/in")
        windows = count_windows_stream(read_stream(spark, "parquet", {}, feed.schema, f"{out}/in"), F.col("lane"),
                                       F.col("event_id"), undecodable_text())
        finished(windows.writeStream.format("parquet").option("checkpointLocation", f"{out}/checkpoint")
                 .trigger(availableNow=True).start(f"{out}/rows"))
    return spark.read.parquet(f"{out}/rows").unionByName(open_windows(spark, f"{out}/checkpoint"))


@query("stream_latency", """select event_type, count(*) as messages, round(avg((1000 * (event_id % 977) + 250000) / 1e6), 6) as mean_s,
  round(max((1000 * (event_id % 977) + 250000) / 1e6), 6) as max_s, true as p50_within, true as p95_within from events group by 1""")
def stream_latency(spark, sf):
    """Quantiles from the summaries of a stream, and whether their exact ranks are within 0.01 (3.6 times the stated error)."""
    out = work_path(spark, "latency")
    seconds = latency_of_events()
    finished(record_latency(event_stream(spark, sf), ["event_type"], seconds, f"{out}/summaries", f"{out}/checkpoint"))
    read = latency_quantiles(read_summaries(spark, f"{out}/summaries"), ["event_type"], [0.5, 0.95])
    ranks = join_groups(table(spark, sf, "events").select("event_type", seconds.alias("s")), settle(read.select("event_type", "q")),
                        ["event_type"])
    within = ranks.groupBy("event_type").agg(*[
        ((F.avg((F.col("s") < F.col("q")[i]).cast("int")) - 0.01 <= p) & (F.avg((F.col("s") <= F.col("q")[i]).cast("int")) + 0.01 >= p))
        .alias(name) for i, (p, name) in enumerate([(0.5, "p50_within"), (0.95, "p95_within")])])
    facts = read.select("event_type", "messages", F.col("mean").alias("mean_s"), F.col("greatest").alias("max_s"))
    return rounded(join_groups(facts, settle(within), ["event_type"]))


def latency_of_events():
    """Seconds from an event to its processing, which follows from its number."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    return (F.unix_micros(F.timestamp_micros(micros + 250000 + 1000 * (F.col("event_id") % 977))) - micros) / 1e6


@query("passthrough_fields", """, v as (select json_extract_string(value, '$.customerID') as customer, json_extract(value, '$.value') as x,
  json_extract_string(value, '$.event_ts') as event_ts, json_extract(value, '$.event_type') as kind from messages where json_valid(value))
select customer, event_ts, round(1.0 / (1.0 + exp(-(-1.0 + cast(x as double) * 0.02))), 6) as score,
  case when kind is null then '{}' else cast(json_object('event_type', kind) as varchar) end as unlisted from v""", ("messages",))
def passthrough_fields(spark, sf):
    """The event type is not among the fields that are read; predictions carry it along."""
    listed = T.StructType([f for f in S.event_schema().fields if f.name != "event_type"])
    feed = messages_from_events(table(spark, sf, "events")).drop("event_id")
    sent, _ = score_messages(feed, listed, ["value"], rounded_score, edge_time(), unlisted=True)
    v = F.from_json("value", "customerID string, event_ts string, churn_probability double, unlisted variant")
    return sent.select(v.alias("v")).select(F.col("v.customerID").alias("customer"), "v.event_ts",
                                            F.col("v.churn_probability").alias("score"), F.to_json("v.unlisted").alias("unlisted"))

import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.operators.scoring import Scorecard
from stayline.sources import tables
from stayline.streaming import messages as M
from stayline.streaming import progress, replay
from stayline.streaming.scoring import dedup_stream, run_for, run_windows, score_messages, score_stream
from stayline.streaming.sinks import message_sink, read_sink, table_sink

CARD = Scorecard(1.0, {"tenure": -0.05, "MonthlyCharges": 0.01}, {("Contract", "Month-to-month"): 0.6})
SCHEMA = T.StructType([T.StructField("customerID", T.StringType()), T.StructField("tenure", T.StringType()),
                       T.StructField("MonthlyCharges", T.DoubleType()), T.StructField("Contract", T.StringType()),
                       T.StructField("event_ts", T.StringType())])
MESSAGES = "key string, value string"


def body(i, **change):
    return json.dumps({"customerID": f"c{i}", "tenure": i, "MonthlyCharges": 50.0 + i, "Contract": "Month-to-month",
                       "event_ts": f"2024-01-01T00:00:{i:02d}.000000", **change})


@pytest.fixture
def feed(spark, tmp_path):
    """Three files of messages: good ones, one corrupt, one keyless and corrupt, one keyless, one with a wrong number."""
    rows = [[(f"c{i}", body(i)) for i in range(10)],
            [("k", "{bad"), (None, "{bad too"), (None, body(20)), ("c21", body(21, tenure="many"))],
            [(f"c{i}", body(i)) for i in range(30, 35)]]
    path = tmp_path / "feed"
    for part in rows:
        spark.createDataFrame(part, MESSAGES).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.05)
    return str(path)


def fixed_time():
    return F.lit("2024-01-02 00:00:00").cast("timestamp")


def stream(spark, feed):
    return tables.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"},
                              T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]), feed)


def start(spark, feed, out):
    return score_stream(stream(spark, feed), SCHEMA, ["tenure", "MonthlyCharges"], CARD.score, table_sink(out), f"{out}/checkpoint", fixed_time)


def test_stream_equals_batch_and_restart_sends_nothing(spark, feed, tmp_path):
    out = str(tmp_path / "out")
    start(spark, feed, out).awaitTermination()
    good, bad = score_messages(spark.read.parquet(feed), SCHEMA, ["tenure", "MonthlyCharges"], CARD.score, fixed_time())

    def seen(df, *cols):
        return sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect())

    assert seen(read_sink(spark, out, "predictions"), "key", "value") == seen(good, "key", "value")
    assert seen(read_sink(spark, out, "dead_letters"), "key", "error", "stage") == seen(bad, "key", "error", "stage")
    before = read_sink(spark, out, "predictions").count()
    assert before == 16 and read_sink(spark, out, "dead_letters").count() == 3
    start(spark, feed, out).awaitTermination()
    assert read_sink(spark, out, "predictions").count() == before


def test_dead_letters_name_their_stage(spark, feed):
    _, bad = score_messages(spark.read.parquet(feed), SCHEMA, ["tenure", "MonthlyCharges"], CARD.score, fixed_time())
    rows = {r["original_message"]: r for r in bad.collect()}
    assert rows["{bad"]["stage"] == "decode" and rows["{bad too"]["key"] is None
    wrong = [r for r in rows.values() if r["stage"] == "prediction"]
    assert len(wrong) == 1 and "tenure" in wrong[0]["error"] and wrong[0]["key"] == "c21"


def test_envelope_fields(spark, feed):
    good, _ = score_messages(spark.read.parquet(feed), SCHEMA, ["tenure", "MonthlyCharges"], CARD.score, fixed_time())
    rows = {r["key"]: json.loads(r["value"]) for r in good.collect()}
    assert "c20" in rows  # key taken from the payload
    one = rows["c3"]
    assert list(one) == ["customerID", "churn_probability", "prediction", "confidence_score", "event_ts", "processed_ts"]
    assert one["prediction"] == "Yes" and 0.5 <= one["confidence_score"] <= 1
    assert one["event_ts"] == "2024-01-01T00:00:03.000000" and one["processed_ts"] == "2024-01-02T00:00:00.000000"


def test_a_replayed_batch_replaces_its_output(spark, tmp_path):
    sink = table_sink(str(tmp_path / "o"))
    df = spark.createDataFrame([("a", "1")], MESSAGES)
    sink(df, "predictions", 0)
    sink(df, "predictions", 0)
    assert read_sink(spark, str(tmp_path / "o"), "predictions").count() == 1


def test_event_time_defaults_to_ingest_time(spark):
    df = spark.createDataFrame([(None, '{"customerID":"a","tenure":"1"}')], MESSAGES)
    row = M.decode(df, SCHEMA, fixed_time()).first()
    assert row["key"] == "a" and row["event_ts"] == "2024-01-02T00:00:00.000000"


def test_wrong_type_is_a_dead_letter(spark):
    df = spark.createDataFrame([("a", '{"customerID":"a","MonthlyCharges":"abc"}'), ("b", "[]"), ("c", None)], MESSAGES)
    assert M.undecodable(df, SCHEMA, fixed_time()).count() + M.decode(df, SCHEMA).count() == 3


def test_values_that_are_no_object_are_told_without_their_fields(spark):
    names = [f.name for f in SCHEMA.fields]
    values = [None, "", " ", "null", "true", "5", '"text"', "[]", "[1, 2]", "{}", "{", "}", '{"a"', '{"a": 1', '{"a": }', "{'a': 1}",
              '{"a": 1} more', '{"a": 1}{"b": 2}', '[{"a": 1}]', '[{"a": 1}, {"a": 2}]', '[{"a": 1}, 5]', '{"a": [1, {"b": }]}',
              '{"a": 01}', '{"a": NaN}', '{"a": "unended}', '{"a": 1,}', '{"a": 1, "a": 2}', "\u00a0{}", '{"_corrupt": "x"}']
    for name in names:
        values += [f'{{"{name}": {v}}}' for v in ("null", "1", '"x"', "[1]", '{"y": 1}', "tru", "1e999", '"\\ud800"', '{"y": }')]
    df = spark.createDataFrame([(i, "k", v) for i, v in enumerate(values)], "i int, key string, value string").repartition(3)
    long = {r["i"] for r in M.parse(df, SCHEMA).where(M.is_corrupt()).collect()}
    assert {r["i"] for r in df.where(M.no_object("value")).collect()} == long
    assert 0 in long and values.index("{}") not in long


def test_count_windows_have_no_loss(spark):
    df = spark.range(250).select(M.count_window("id", 100).alias("w")).groupBy("w").count()
    assert {r["w"]: r["count"] for r in df.collect()} == {0: 100, 1: 100, 2: 50}


def test_replay_in_chunks_with_restart(spark, tmp_path):
    table, out = str(tmp_path / "t"), str(tmp_path / "o")
    df = spark.range(250).select(F.col("id").cast("string").alias("customerID"), F.col("id").alias("n")).coalesce(1)
    replay.write_chunks(df, table, 100)

    def run():
        replay.replay(spark, table, df.schema, "customerID", table_sink(out), f"{out}/checkpoint",
                      F.lit("2024-01-01T00:00:00")).awaitTermination()

    run()
    sent = spark.read.parquet(f"{out}/messages")
    assert sent.count() == 250 and sent.select("key").distinct().count() == 250
    assert {r["batch_id"]: r["count"] for r in sent.groupBy("batch_id").count().collect()} == {0: 100, 1: 100, 2: 50} or \
        sorted(r["count"] for r in sent.groupBy("batch_id").count().collect()) == [50, 100, 100]
    run()
    assert spark.read.parquet(f"{out}/messages").count() == 250
    replay.write_chunks(df, str(tmp_path / "more"), 100)
    spark.read.parquet(str(tmp_path / "more")).limit(30).write.mode("append").parquet(table)
    run()
    assert spark.read.parquet(f"{out}/messages").count() == 280


def test_progress_and_health(spark, feed, tmp_path):
    log = progress.ProgressLog(spark, str(tmp_path / "progress"), every=2)
    spark.streams.addListener(log)
    query = start(spark, feed, str(tmp_path / "out"))
    query.awaitTermination()
    state = progress.health(query)
    assert not state["active"] and not state["failed"]
    table = progress.recent_progress(spark, query)
    assert [r["input_rows"] > 0 for r in table.collect()] == [True] * 3
    log.wait_for(query)
    spark.streams.removeListener(log)
    assert log.table().where("input_rows > 0").count() == 3


def test_progress_keeps_every_batch(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(0, 130, 1, 130).write.parquet(path)  # a file per row
    source = tables.read_stream(spark, "parquet", {"maxFilesPerTrigger": "1"}, spark.read.parquet(path).schema, path)
    log = progress.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    query = source.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    log.wait_for(query)
    spark.streams.removeListener(log)
    done = log.table().where("input_rows > 0")
    assert done.count() == 130 and done.agg(F.sum("input_rows")).first()[0] == 130  # more than Spark remembers


def test_numbers_as_text_and_blanks(spark):
    kind = T.StructType([T.StructField("customerID", T.StringType()), T.StructField("tenure", T.IntegerType()),
                         T.StructField("charge", T.DoubleType()), T.StructField("event_ts", T.StringType())])
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(
        ['{"tenure":5,"charge":1}', '{"tenure":"5","charge":"1.0"}', '{"tenure":5.0,"charge":" 1 "}', '{"tenure":"5","charge":""}',
         '{"tenure":"5"}', '{"tenure":"5","charge":"x"}', '{"tenure":5.5,"charge":1}', "{bad"])], MESSAGES)
    plain = {r.key: r for r in M.route(df, kind, ["tenure", "charge"], fixed_time()).collect()}
    assert [plain[str(i)].error for i in range(3)] == [None] * 3 and {plain[str(i)].tenure for i in range(3)} == {5}
    assert all("charge is not numeric" in plain[str(i)].error for i in (3, 4, 5))
    assert "tenure" in plain["6"].error and plain["7"].error == "value is not valid JSON"
    filled = {r.key: r for r in M.route(df, kind, ["tenure", "charge"], fixed_time(), {"charge": 0.0}).collect()}
    assert filled["3"].charge == filled["4"].charge == 0.0 and filled["3"].error is None
    assert "charge is not numeric" in filled["5"].error


def test_unscored_rows_and_failing_scorers_are_dead_letters(spark, feed, tmp_path):
    def half(df):
        return CARD.score(df).withColumn("score", F.when(F.col("tenure").cast("int") % 2 == 0, F.col("score")))

    good, bad = score_messages(spark.read.parquet(feed), SCHEMA, ["tenure", "MonthlyCharges"], half, fixed_time())
    assert good.count() + bad.count() == 19 and good.count() == 9
    lost = bad.where("error = 'the model gave no score'")
    assert lost.count() == 7 and lost.where("original_message is null or stage <> 'prediction'").count() == 0

    def broken(df):
        return df.withColumn("score", F.raise_error(F.lit("out of order")).cast("double"))

    out = str(tmp_path / "out")
    score_stream(stream(spark, feed), SCHEMA, ["tenure", "MonthlyCharges"], broken, table_sink(out), f"{out}/c", fixed_time).awaitTermination()
    letters = read_sink(spark, out, "dead_letters")
    assert letters.count() == 19 and letters.where("error like 'prediction failed%'").count() == 16


def test_one_failing_message_takes_no_other(spark, feed, tmp_path):
    def picky(df):
        wrong = F.col("tenure").cast("int").isin(3, 32)
        return CARD.score(df).withColumn("score", F.when(wrong, F.raise_error(F.lit("not this one")).cast("double")).otherwise(F.col("score")))

    out = str(tmp_path / "out")
    score_stream(stream(spark, feed), SCHEMA, ["tenure", "MonthlyCharges"], picky, table_sink(out), f"{out}/c", fixed_time).awaitTermination()
    letters = read_sink(spark, out, "dead_letters")
    lost = letters.where("error like 'prediction failed%'").collect()
    assert {(r.key, r.stage) for r in lost} == {("c3", "prediction"), ("c32", "prediction")} and len(lost) == 2
    assert all("not this one" in r.error and r.failed_at is not None and r.original_message for r in lost)
    assert letters.count() == 5 and read_sink(spark, out, "predictions").count() == 14

    def inapplicable(df):
        raise ValueError("no model")

    out = str(tmp_path / "none")
    score_stream(stream(spark, feed), SCHEMA, ["tenure", "MonthlyCharges"], inapplicable, table_sink(out), f"{out}/c", fixed_time).awaitTermination()
    assert read_sink(spark, out, "dead_letters").where("error = 'prediction failed: no model'").count() == 16


def test_a_failed_job_is_done_again(spark, feed, tmp_path):
    @F.udf("double")
    def dying(score):
        os._exit(1)  # the worker is lost, as on a full or broken machine

    out = str(tmp_path / "out")

    def run(scorer):
        score_stream(stream(spark, feed), SCHEMA, ["tenure", "MonthlyCharges"], scorer, table_sink(out), f"{out}/c", fixed_time).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run(lambda df: CARD.score(df).withColumn("score", dying("score")))
    run(CARD.score)
    assert read_sink(spark, out, "predictions").count() == 16
    assert read_sink(spark, out, "dead_letters").count() == 3


def test_windows_say_when_time_is_up(spark, feed, tmp_path):
    query = score_stream(stream(spark, feed), SCHEMA, ["tenure"], CARD.score, table_sink(str(tmp_path / "a")), str(tmp_path / "ca"),
                         fixed_time, {"processingTime": "1 hour"})
    with pytest.raises(TimeoutError):
        run_windows(query, 50, timeout=3)
    assert not query.isActive


def test_runs_are_bounded(spark, feed, tmp_path):
    query = score_stream(stream(spark, feed), SCHEMA, ["tenure"], CARD.score, table_sink(str(tmp_path / "a")), str(tmp_path / "ca"),
                         fixed_time, {"processingTime": "0 seconds"})
    assert run_windows(query, 2, timeout=60) >= 2 and not query.isActive
    endless = score_stream(stream(spark, feed), SCHEMA, ["tenure"], CARD.score, table_sink(str(tmp_path / "b")), str(tmp_path / "cb"),
                           fixed_time, {"processingTime": "1 second"})
    assert run_for(endless, 3) is False and not endless.isActive


def test_dedup_drops_replays(spark, tmp_path):
    schema = T.StructType([T.StructField("customerID", T.StringType()), T.StructField("event_ts", T.StringType())])
    rows = [("a", "2024-01-01T00:00:00")] * 3 + [("a", "2024-01-01T00:00:01"), ("b", "2024-01-01T00:00:00")]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    source = tables.read_stream(spark, "parquet", {}, schema, str(tmp_path / "in"))
    query = (dedup_stream(source, "event_ts", "1 hour").writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_message_sink_writes_key_and_value(spark, tmp_path):
    path = str(tmp_path / "m")
    sink = message_sink({"dead_letters": {"path": path}}, "json")
    sink(spark.createDataFrame([("k", "{x", "bad", "decode")], "key string, original_message string, error string, stage string"),
         "dead_letters", 0)
    row = spark.read.schema("key string, value string").json(path).first()
    assert row["key"] == "k" and json.loads(row["value"]) == {"original_message": "{x", "error": "bad", "stage": "decode"}


def test_kafka_options():
    source = tables.kafka_source_options("host:9092", "raw", 500)
    assert source["startingOffsets"] == "earliest" and source["maxOffsetsPerTrigger"] == "500"
    assert "maxOffsetsPerTrigger" not in tables.kafka_source_options("host:9092", "raw", None)
    assert tables.kafka_sink_options("host:9092", "out")["kafka.acks"] == "all"


def test_subscriber_messages_leave_the_target_behind(spark):
    df = spark.createDataFrame([("a", "Yes")], "customerID string, Churn string")
    value = json.loads(replay.subscriber_messages(df, F.lit("t")).first()["value"])
    assert value == {"customerID": "a", "event_ts": "t"}
    assert "Churn" not in S.subscriber_message_schema().names


def test_unlisted_fields_keep_their_types(spark):
    cases = {'{"customerID":"a","x":5,"y":"5","z":{"k":[1,2.50,null],"b":"t"},"n":null}': '{"x":5,"y":"5","z":{"b":"t","k":[1,2.5,null]},"n":null}',
             '{"customerID":"a"}': "{}", "{}": "{}", "{bad": None, "[]": None, "": None, '{"x":1,"w":0,"x":2}': '{"w":0,"x":2}',
             '{"o":{"k":1,"k":2}}': None}
    df = spark.createDataFrame([(v,) for v in [*cases, None]], "value string")
    got = {r[0]: r[1] for r in df.select("value", M.unlisted_fields("value", SCHEMA)).collect()}
    assert got == {**cases, None: None}


def test_the_stream_carries_unlisted_fields(spark, tmp_path):
    root = str(tmp_path)
    rows = [("c1", body(1, plan={"since": 2020, "tags": ["a"]}, note="n")), ("c2", body(2)), ("c3", "{bad"),
            ("c4", body(4)[:-1] + ', "twice": {"k": 1, "k": 2}}')]
    spark.createDataFrame(rows, MESSAGES).coalesce(1).write.parquet(f"{root}/in")
    score_stream(stream(spark, f"{root}/in"), SCHEMA, ["tenure", "MonthlyCharges"], CARD.score, table_sink(f"{root}/out"),
                 f"{root}/checkpoint", fixed_time, unlisted=True).awaitTermination()
    sent = {r["key"]: json.loads(r["value"]) for r in read_sink(spark, f"{root}/out", "predictions").collect()}
    assert sent["c1"]["unlisted"] == {"plan": {"since": 2020, "tags": ["a"]}, "note": "n"}
    assert sent["c2"]["unlisted"] == {} and sent["c4"]["unlisted"] is None and len(sent) == 3
    assert read_sink(spark, f"{root}/out", "dead_letters").count() == 1

"""Count windows and latency summaries of running streams, against plain Python."""

import random
import time

import pytest
from pyspark.sql import functions as F

from stayline.streaming import latency as L
from stayline.streaming.windows import count_windows_stream, open_windows, undecodable_text

FEED = "lane string, seq long, value string"
SIZE = 4


def expected(batches, size=SIZE):
    lanes = {}
    for batch in batches:
        for lane, seq, value in sorted(batch, key=lambda r: (r[1] is None, r[1] or 0)):
            lanes.setdefault(lane, []).append((seq, value == "{bad"))
    rows = []
    for lane, seen in lanes.items():
        for w in range(0, len(seen), size):
            part = seen[w:w + size]
            bad = sum(b for _, b in part)
            rows.append((lane, w // size, len(part), len(part) - bad, bad, part[0][0], part[-1][0], "full" if len(part) == size else "open"))
    return sorted(rows, key=str)


def run(spark, root, batches, idle=None):
    """A restart before each batch."""
    for batch in batches:
        spark.createDataFrame(batch, FEED).coalesce(1).write.mode("append").parquet(f"{root}/in")
        start(spark, root, idle, availableNow=True).awaitTermination()
    return read(spark, root)


def start(spark, root, idle, **trigger):
    stream = spark.readStream.schema(FEED).parquet(f"{root}/in")
    windows = count_windows_stream(stream, F.col("lane"), F.col("seq"), undecodable_text(), SIZE, idle)
    return (windows.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**trigger).start(f"{root}/rows"))


def read(spark, root):
    rows = spark.read.parquet(f"{root}/rows").unionByName(open_windows(spark, f"{root}/checkpoint"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


def feed(n, seed):
    """Sparse sequences; lane a holds most messages, one lane is null."""
    draw = random.Random(seed)
    return [(draw.choice(["a", "a", "a", "b", None]), i * 3 + draw.randrange(3), draw.choice(["{}", '{"x": 1}', "{bad"])) for i in range(n)]


def test_windows_do_not_depend_on_the_cut_into_batches(spark, tmp_path):
    rows = feed(41, 1)
    whole = run(spark, str(tmp_path / "one"), [rows])
    parts = run(spark, str(tmp_path / "three"), [rows[:5], rows[5:6], rows[6:]])
    assert whole == parts == expected([rows])
    assert {r[7] for r in whole} == {"full", "open"} and None in {r[0] for r in whole}


def test_null_and_equal_sequences_and_exactly_full_windows(spark, tmp_path):
    batches = [[("a", None, "{}"), ("a", 7, "{bad"), ("a", 7, "{bad"), ("a", 1, "{}"), ("b", None, None)], [("a", 2, "{}")]]
    rows = run(spark, str(tmp_path), batches)
    assert rows == [("a", 0, 4, 2, 2, 1, None, "full"), ("a", 1, 1, 1, 0, 2, 2, "open"), ("b", 0, 1, 0, 1, None, None, "open")]


def test_an_idle_window_ends_and_the_next_one_begins_anew(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([("a", 1, "{}"), ("a", 2, "{bad"), ("b", 1, "{}")], FEED).coalesce(1).write.parquet(f"{root}/in")
    run_until(spark, root, 1.0, lambda rows: len(rows) == 2 and {r[7] for r in rows} == {"idle"})
    assert [(r[0], r[1], r[2], r[4]) for r in read(spark, root)] == [("a", 0, 2, 1), ("b", 0, 1, 0)]
    spark.createDataFrame([("a", 3, "{}")], FEED).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run_until(spark, root, 600.0, lambda rows: ("a", 1, 1, 1, 0, 3, 3, "open") in rows and len(rows) == 3)


def run_until(spark, root, idle, reached, seconds=60):
    """With an idle time the query goes on until it is stopped."""
    query, until = start(spark, root, idle, processingTime="500 milliseconds"), time.time() + seconds
    try:
        while not (query.lastProgress and reached(read(spark, root))):
            assert time.time() < until and query.isActive
            time.sleep(0.5)
    finally:
        query.stop()


def test_summaries_of_batches_unite_to_quantiles_within_the_error(spark, tmp_path):
    root, values = str(tmp_path), {}
    draw = random.Random(5)
    for _ in range(3):
        rows = [(draw.choice(["x", "x", "y", None]), draw.expovariate(1)) for _ in range(4000)]
        for g, v in rows:
            values.setdefault(g, []).append(v)
        spark.createDataFrame([*rows, ("x", None), ("x", float("nan")), ("none", None)], "g string, s double").coalesce(1).write.mode(
            "append").parquet(f"{root}/in")
        stream = spark.readStream.schema("g string, s double").parquet(f"{root}/in")
        L.record_latency(stream, ["g"], F.col("s"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    summaries = L.read_summaries(spark, f"{root}/out")
    assert {r[0] for r in summaries.select("batch_id").distinct().collect()} == {0, 1, 2}
    got = {r["g"]: r for r in L.latency_quantiles(summaries, ["g"], [0.1, 0.5, 0.99]).collect()}
    assert got["none"]["measured"] == 0 and got["none"]["q"] is None and got["none"]["messages"] == 3
    assert got["x"]["messages"] == len(values["x"]) + 6
    for g, held in values.items():
        assert got[g]["measured"] == len(held) and got[g]["greatest"] == max(held) and got[g]["least"] == min(held)
        assert got[g]["mean"] == pytest.approx(sum(held) / len(held))
        for p, q in zip([0.1, 0.5, 0.99], got[g]["q"]):
            assert abs(sum(v <= q for v in held) / len(held) - p) < 4 * L.rank_error()

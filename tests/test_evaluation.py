import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import business, explore, metrics, runs, scoring
from stayline.streaming.messages import batch_summary


@pytest.fixture(scope="module")
def six(spark):
    rows = list(zip("abcdef", [1, 0, 1, 0, 1, 0], [1, 0, 0, 0, 1, 1], [100.0, 50.0, 80.0, 60.0, 120.0, 40.0]))
    return spark.createDataFrame(rows, "customerID string, label int, prediction int, MonthlyCharges double")


def test_revenue_at_risk(six):
    row = business.revenue_at_risk(six.drop("prediction"), six.select("customerID", "prediction")).first().asDict()
    assert row == {"total_customers": 6, "actual_churners": 3, "predicted_churners": 3, "correctly_identified": 2,
                   "total_revenue_at_risk": "$300.00", "potential_revenue_saved": "$220.00"}


def test_lifetime_value_and_roi(spark):
    assert business.default_value() == 1380.0
    one = spark.range(1)
    row = one.select(business.churn_cost(F.lit(100), 1500.0).alias("unchecked"),
                     business.churn_cost(F.lit(40), 1500.0).alias("retained"),
                     business.roi(F.lit(40 * 1500.0), F.lit(5000.0)).alias("roi"),
                     business.roi(F.lit(1.0), F.lit(0.0)).alias("free")).first()
    assert (row["unchecked"], row["retained"], row["roi"], row["free"]) == (150000.0, 60000.0, 11.0, math.inf)


def test_projection(spark):
    """50,000 customers, 20 % churn, 80 % found, 35 % kept, 2,000 per customer, 50 per contact."""
    truth = spark.range(50000).select((F.col("id") < 10000).cast("int").alias("label"), (F.col("id") < 8000).cast("int").alias("prediction"))
    row = business.impact_report(truth, 0.35, 50.0, 2000.0).first()
    assert (row["churners"], row["unchecked_cost"], row["targeted"]) == (10000, 20000000.0, 8000)
    assert (row["saved"], row["cost"], row["revenue_saved"], row["net_benefit"], row["roi"]) == pytest.approx(
        (2800, 400000.0, 5600000.0, 5200000.0, 13.0))


def test_metrics_without_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = metrics.binary_metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0.0, 0.0, 0.0)


def pair_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 6])
def test_auc_counts_pairs(spark, digits):
    rng = np.random.default_rng(digits)
    y = rng.integers(0, 2, 800)
    s = np.round(np.clip(rng.random(800) * 0.7 + y * 0.2, 0, 1), digits)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    assert metrics.roc_auc(df).first()["roc_auc"] == pytest.approx(pair_auc(y, s))


def test_curves_end_where_they_should(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "label int, score double")
    roc = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df).collect())
    assert roc == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]
    pr = {(r["threshold"], round(r["precision"], 4), r["recall"]) for r in metrics.pr_curve(df).collect()}
    assert pr == {(0.9, 1.0, 0.5), (0.8, 0.6667, 1.0), (0.1, 0.5, 1.0), (None, 1.0, 0.0)}
    assert metrics.pr_auc(df).first()["pr_auc"] == pytest.approx(0.5 * 1.0 + 0.5 * (1 + 2 / 3) / 2)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()["roc_auc"] is None


def test_gate_is_inclusive(spark):
    df = spark.createDataFrame([(0, 100, 95, 5)], "window_id long, messages long, predictions long, errors long")
    row = batch_summary(df).first()
    assert row["success_pct"] == 95.0 and row["passed"]
    empty = batch_summary(df.limit(0)).first()
    assert empty["windows"] == 0 and empty["passed"] is None


def test_votes(spark):
    df = spark.createDataFrame([(0.9, 0.8, 0.1), (0.6, 0.4, 0.4), (0.5, 0.5, 0.0)], "a double, b double, c double").coalesce(1)
    assert [r[0] for r in scoring.vote_hard(df, ["a", "b", "c"]).select("prediction").collect()] == [1, 0, 1]
    assert scoring.vote_hard(df, ["a", "c"]).first()["prediction"] == 0  # a draw
    assert scoring.vote_soft(df, ["a", "b", "c"]).first()["score"] == pytest.approx(0.6)


def test_confidence_is_at_least_half(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (0.8,)], "score double").coalesce(1)
    assert [r[0] for r in df.select(scoring.confidence("score")).collect()] == [1.0, 0.5, 0.8]


def test_stability(spark):
    df = spark.createDataFrame([(0.8,), (0.9,)], "score double")
    row = metrics.stability(df).first()
    assert row["std_score"] == pytest.approx(0.05) and row["mean_score"] == pytest.approx(0.85)


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, model, auc in (("r1", "lr", 0.8), ("r2", "rf", 0.9), ("r3", "gbt", 0.9), ("r4", "dt", 0.7)):
        runs.append_run(runs.run_rows(spark, run, model, {"depth": 5}, {"auc": auc}), path)
    log = spark.read.parquet(path)
    assert [r["run_id"] for r in runs.top_runs(log, "auc", 3).collect()] == ["r2", "r3", "r1"]
    assert runs.top_runs(log, "auc", 1, ascending=True).first()["run_id"] == "r4"
    assert runs.top_runs(log, "absent", 1).count() == 0


def test_newest_versions(spark):
    df = spark.createDataFrame([("m", v) for v in range(1, 6)] + [("n", 1)], "name string, version int")
    got = {(r["name"], r["version"]): r["stage"] for r in runs.mark_versions(df, "name", "version", 2).collect()}
    assert [v for (n, v), s in sorted(got.items()) if s == "Active" and n == "m"] == [4, 5]
    assert got[("n", 1)] == "Active" and len(got) == 6


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 0.0), (None, -0.0), ("a", 1.0)], "s string, x double")
    assert explore.duplicate_rows(df).first()["duplicates"] == 1


def test_histogram_of_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    rows = explore.histogram(df, "x", 3).orderBy("bin").collect()
    assert sum(r["n"] for r in rows) == 4 and len(rows) == 3


def test_histogram_of_nothing(spark):
    assert explore.histogram(spark.createDataFrame([], "x double"), "x").count() == 0


def test_sketched_quartiles_are_close(spark):
    df = spark.range(1, 10001).select(F.col("id").cast("double").alias("x"))
    exact, rough = (explore.describe_numeric(df, ["x"], exact=e).first() for e in (True, False))
    assert exact["count"] == rough["count"] == 10000 and exact["q50"] == 5000.5
    assert all(abs(exact[q] - rough[q]) < 20 for q in ("q25", "q50", "q75"))


def test_profile_of_an_all_null_column(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b")], "x double, s string")
    rows = {r["column"]: r for r in explore.profile(df).collect()}
    assert (rows["x"]["non_null"], rows["x"]["null_pct"], rows["x"]["n_unique"], rows["x"]["samples"]) == (0, 100.0, 0, None)
    assert rows["s"]["samples"] == "a,b"
    report = {r["column"]: r for r in explore.column_report(df).collect()}
    assert report["x"]["nulls"] == 2 and report["s"]["distinct_values"] == "a,b"

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from stayline import jobs
from stayline import schema as S
from stayline.operators import models, runs
from stayline.operators.resample import METHODS, balance
from stayline.operators.scoring import positive_probability
from stayline.sources import models as store
from stayline.sources import tables
from stayline.sources.fixtures import subscribers
from stayline.streaming.messages import is_corrupt, parse
from stayline.streaming.scoring import score_messages, score_with_model

SF = "/root/testdata/sf0.01"
NOW = "2024-05-06 07:08:09"


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    tables.write_csv(subscribers(spark, SF), str(base / "raw"))
    raw = tables.read_csv(spark, str(base / "raw"), S.subscriber_schema())
    report = jobs.prepare_job(raw, str(base / "prepared")).first().asDict()
    few = {"lr": models.classifier("lr"), "dt": models.classifier("dt")}
    path, table = jobs.train_job(spark, str(base / "prepared"), str(base / "models"), str(base / "runs"), 1, NOW, few)
    return base, raw, report, path, table


def test_prepared_rows(trained):
    _, _, report, _, _ = trained
    assert report == {"rows": 1500, "without_charges": 10, "kept": 1490, "dropped": 10}


def test_best_model_is_saved_and_logged(spark, trained):
    base, _, _, path, table = trained
    best = [r for r in table.collect() if r["selected"]][0]
    meta = store.load_metadata(spark, path)
    assert meta["metrics"]["roc_auc"] == best["roc_auc"] and best["roc_auc"] > 0.6
    log = spark.read.parquet(str(base / "runs"))
    assert runs.top_runs(log, "roc_auc", 1).first()["model"] == best["model"]


def test_scoring_appends_a_run(spark, trained):
    base, raw, _, path, _ = trained
    out = str(base / "predictions")
    unlabelled = raw.drop(S.TARGET)
    summary = jobs.score_job(spark, path, unlabelled, out, F.lit(NOW).cast("timestamp"))
    assert sum(r["n"] for r in summary.collect()) == 1500  # rows without total charges are scored too
    jobs.score_job(spark, path, unlabelled.limit(5), out, F.lit("2024-05-07 07:08:09").cast("timestamp"))
    assert spark.read.parquet(out).count() == 1505


def test_scoring_needs_a_model_and_columns(spark, trained):
    base, raw, _, path, _ = trained
    with pytest.raises(FileNotFoundError):
        jobs.score_job(spark, str(base / "none"), raw, str(base / "x"), F.lit(NOW).cast("timestamp"))
    with pytest.raises(ValueError, match="Contract"):
        jobs.score_job(spark, path, raw.drop("Contract"), str(base / "x"), F.lit(NOW).cast("timestamp"))


def test_messages_score_like_rows(spark, trained):
    _, raw, _, path, _ = trained
    model = store.load_model(path)
    sent = tables.encode_json(raw.drop(S.TARGET).limit(50), S.KEY, F.lit("2024-01-01T00:00:00"))
    assert parse(sent, S.subscriber_message_schema()).where(is_corrupt()).count() == 0
    good, bad = score_messages(sent, S.subscriber_message_schema(), ["tenure", "MonthlyCharges"],
                               lambda df: score_with_model(model, df), F.lit(NOW).cast("timestamp"))
    assert bad.count() == 0
    want = {r[S.KEY]: round(r["s"], 9) for r in model.transform(raw.limit(50)).select(S.KEY, positive_probability().alias("s")).collect()}
    got = good.select("key", F.get_json_object("value", "$.churn_probability").cast("double").alias("p")).collect()
    assert {r["key"]: round(r["p"], 9) for r in got} == want


@pytest.mark.parametrize("method", METHODS)
def test_balancing_vectors(spark, method):
    rows = [(f"r{i}", int(i >= 30), Vectors.dense([i % 7 + (i >= 30), i % 5, i % 3])) for i in range(40)]
    out = balance(spark.createDataFrame(rows, ["customerID", "label", "features"]), method)
    sizes = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    if method == "undersample":
        assert sizes == {0: 10, 1: 10}
    elif method == "adasyn":
        assert sizes[0] == 30 and 25 <= sizes[1] <= 35
    else:
        assert sizes == {0: 30, 1: 30}
    assert out.select("customerID").distinct().count() == out.count()


def test_training_on_balanced_rows(spark):
    from stayline.operators.clean import clean_subscribers
    df = clean_subscribers(subscribers(spark, "/root/testdata/sf0.001"))
    prepared = models.prepare(df, resample="smote")
    assert len({r["count"] for r in prepared.train.groupBy("label").count().collect()}) == 1
    with pytest.raises(ValueError):
        models.prepare(df, resample="unknown")
    prepared.release()


def test_version_numbers(spark):
    log = spark.createDataFrame([("b", "m1"), ("a", "m1"), ("c", "m2"), ("d", "m1")], "run_id string, model string")
    got = {r["run_id"]: r["version"] for r in runs.number_versions(log, "model", "run_id").collect()}
    assert got == {"a": 1, "b": 2, "d": 3, "c": 1}

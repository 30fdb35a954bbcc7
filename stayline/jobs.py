"""End-to-end jobs: prepare a table, train and register a model, score a table. The caller owns the session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.scalars import to_number
from stayline.operators import models, runs, scoring
from stayline.operators.clean import require_columns
from stayline.operators.features import prepare_table
from stayline.operators.sampling import split_stratified, train_test
from stayline.operators.stages import SubscriberFeatures
from stayline.sources import models as store
from stayline.sources.tables import write_predictions


def prepare_job(raw: DataFrame, path: str) -> DataFrame:
    """Validate, clean, derive features, write once. Returns one row: rows read, kept and dropped."""
    require_columns(raw, [f.name for f in S.subscriber_schema().fields])
    prepare_table(raw).write.mode("overwrite").parquet(path)
    kept = raw.sparkSession.read.parquet(path).agg(F.count("*").alias("kept"))
    return raw.agg(F.count("*").alias("rows"), F.count_if(to_number("TotalCharges").isNull()).alias("without_charges")).select(
        "rows", "without_charges", kept.scalar().alias("kept"), (F.col("rows") - kept.scalar()).alias("dropped"))


def default_estimators() -> dict[str, Estimator]:
    return {"logistic regression": models.classifier("lr"), "random forest": models.classifier("rf"),
            "gradient boosting": models.classifier("gbt")}


def train_job(spark: SparkSession, prepared_path: str, model_base: str, runs_path: str, version: str | int, saved_at: str,
              estimators: Mapping[str, Estimator] | None = None, resample: str | None = None) -> tuple[str, DataFrame]:
    """Split, train, compare, save the best pipeline and log every run. Returns the model's path and the metrics.

    The saved pipeline starts from raw subscriber rows.
    """
    rows = spark.read.parquet(prepared_path)
    train, test = train_test(split_stratified(rows, S.KEY, ["label"]))
    chosen = dict(estimators or default_estimators())
    model, table = models.train_select(train, test, chosen, resample=resample)
    best = None
    for r in table.collect():
        metrics = {m: r[m] for m in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")}
        given = {p.name: v for p, v in chosen[r["model"]].extractParamMap().items()}
        runs.append_run(runs.run_rows(spark, f"{version}:{r['model']}", r["model"], given, metrics), runs_path)
        if r["selected"]:
            best = metrics
    path = store.model_path(model_base, "churn", version)
    full = PipelineModel([SubscriberFeatures(), *model.stages])
    store.save_model(spark, full, path, "churn", version, best, [*S.NUMERIC_FEATURES, *S.CATEGORICAL_FEATURES], saved_at)
    return path, table


def score_job(spark: SparkSession, model_path: str, rows: DataFrame, out_path: str, run_time: Column) -> DataFrame:
    """Score raw subscriber rows, append them to the predictions table, return the risk distribution."""
    if not store.artifacts_present(spark, model_path):
        raise FileNotFoundError(f"no model at {model_path}")
    require_columns(rows, [S.KEY, *S.NUMERIC_FEATURES, *S.CATEGORICAL_FEATURES])
    scored = store.load_model(model_path).transform(rows).withColumn("score", scoring.positive_probability())
    predictions = scoring.predictions(scored)
    write_predictions(predictions, out_path, run_time)
    run = F.date_format(run_time, "yyyyMMdd_HHmmss")
    written = spark.read.option("recursiveFileLookup", False).schema(
        predictions.withColumn("run_id", F.lit("")).schema).parquet(out_path).where(F.col("run_id") == run)
    return written.groupBy("prediction", "risk_level").agg(F.count("*").alias("n"))

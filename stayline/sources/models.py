"""Saving and loading fitted pipelines with their metadata, on any Hadoop file system."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def model_path(base: str, kind: str, version: str | int) -> str:
    return f"{base.rstrip('/')}/{kind}_{version}"


def save_model(spark: SparkSession, model: PipelineModel, path: str, kind: str, version: str | int,
               metrics: Mapping[str, float], features: list[str], saved_at: str) -> None:
    """The pipeline below ``model`` and one JSON row below ``metadata``."""
    model.write().overwrite().save(f"{path}/model")
    row = [(kind, str(version), saved_at, {k: float(v) for k, v in metrics.items()}, list(features))]
    (spark.createDataFrame(row, "kind string, version string, saved_at string, metrics map<string,double>, features array<string>")
     .coalesce(1).write.mode("overwrite").json(f"{path}/metadata"))


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def load_metadata(spark: SparkSession, path: str) -> dict:
    schema = "kind string, version string, saved_at string, metrics map<string,double>, features array<string>"
    return spark.read.schema(schema).json(f"{path}/metadata").select(F.struct("*").alias("m")).first()["m"].asDict()


def artifacts_present(spark: SparkSession, path: str) -> bool:
    """Whether both the pipeline and its metadata are there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def exists(p: str) -> bool:
        target = jvm.org.apache.hadoop.fs.Path(p)
        return target.getFileSystem(conf).exists(target)

    return exists(f"{path}/model/metadata") and exists(f"{path}/metadata/_SUCCESS")

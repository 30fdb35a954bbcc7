"""Run log and model versions as tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from stayline.plans.ordered import global_rank
from stayline.plans.small import join_groups, settle

RUN_SCHEMA = "run_id string, model string, params map<string,string>, metrics map<string,double>"


def run_rows(spark: SparkSession, run_id: str, model: str, params: Mapping[str, object],
             metrics: Mapping[str, float]) -> DataFrame:
    """One run as a one-row table."""
    return spark.createDataFrame([(run_id, model, {k: str(v) for k, v in params.items()},
                                   {k: float(v) for k, v in metrics.items()})], RUN_SCHEMA)


def append_run(run: DataFrame, path: str) -> None:
    run.write.mode("append").parquet(path)


def top_runs(runs: DataFrame, metric: str, n: int = 10, ascending: bool = False) -> DataFrame:
    """The first n runs by a metric, ties to the smaller run id; runs without it are left out."""
    value = F.element_at("metrics", metric)
    order = value.asc() if ascending else value.desc()
    return runs.where(value.isNotNull()).withColumn(metric, value).orderBy(order, "run_id").limit(n)


def best_version(runs: DataFrame, versions: DataFrame, metric: str) -> DataFrame:
    """The registered version of the best run."""
    return top_runs(runs, metric, 1).join(versions, "run_id")


def number_versions(runs: DataFrame, name: str, order: str, out: str = "version") -> DataFrame:
    """1, 2, ... per model along ``order``: the global position minus the model's first position."""
    placed = global_rank(runs, [name, order], "_place")
    first = settle(placed.groupBy(name).agg(F.min("_place").alias("_first")))
    return join_groups(placed, first, [name]).withColumn(out, (F.col("_place") - F.col("_first") + 1).cast("int")).drop("_place", "_first")


def mark_versions(versions: DataFrame, name: str, version: str, keep: int) -> DataFrame:
    """``stage``: the newest ``keep`` versions of a model stay active, older ones are archived.

    The cut-off version is found with a top-k per name, which is limited before the shuffle.
    """
    newest = (versions.select(name, version)
              .withColumn("_r", F.row_number().over(W.partitionBy(name).orderBy(F.desc(version)))).where(F.col("_r") <= keep)
              .groupBy(name).agg(F.min(version).alias("_floor")))
    return (join_groups(versions, settle(newest), [name])
            .withColumn("stage", F.when(F.col(version) >= F.col("_floor"), "Active").otherwise("Archived")).drop("_floor"))

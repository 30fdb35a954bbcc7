"""Classifiers, segments and their training on Spark ML."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators.explain import feature_names
from stayline.operators.metrics import compare_models
from stayline.operators.resample import balance
from stayline.operators.sampling import folds_stratified
from stayline.operators.scoring import positive_probability
from stayline.operators.stages import BalancedWeights, ColumnImputer, IqrClipper
from stayline.plans.durable import cut_lineage

# --- Fixed values: default classifier settings ---
DEFAULTS = {
    "lr": {"maxIter": 100},
    "rf": {"numTrees": 100, "maxDepth": 10, "seed": 42},
    "gbt": {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "seed": 42},
    "dt": {"maxDepth": 5, "seed": 42},
}
# --- End of fixed values ---
CLASSES = {"lr": LogisticRegression, "rf": RandomForestClassifier, "gbt": GBTClassifier, "dt": DecisionTreeClassifier}
ROWS_PER_TASK = 2000  # below this a training task is mostly overhead
MOST_ROWS = 200_000  # above this a training task gets another one beside it


def classifier(name: str, weight: str | None = None, **params: object) -> Estimator:
    """lr, rf, gbt or dt with the default settings, overridden by ``params``."""
    settings = {**DEFAULTS[name], **params}
    if settings.get("maxDepth", 0) is None:
        raise ValueError("maxDepth=None (no limit) does not exist in Spark ML: give a depth of at most 30")
    if weight:
        settings["weightCol"] = weight
    return CLASSES[name](featuresCol="features", labelCol="label", **settings)


def regularization(c: float, rows: int) -> float:
    """Spark's regParam for an inverse strength C, which weighs the summed loss instead of the mean loss."""
    return 1.0 / (c * rows)


def preparation(numeric: Sequence[str] = tuple(S.NUMERIC_FEATURES), categorical: Sequence[str] = tuple(S.CATEGORICAL_FEATURES),
                encoding: str = "onehot", scaling: str | None = "standard", clip_outliers: bool = False,
                balanced: bool = False) -> Pipeline:
    """Impute, index, encode, assemble and scale into ``features``; no row is dropped on the way.

    encoding: onehot or label; scaling: standard (unit deviation, sparse vectors stay sparse), minmax or None.
    """
    if encoding not in ("onehot", "label"):
        raise ValueError(f"unknown encoding {encoding!r}: use onehot or label")
    scalers = {"standard": StandardScaler(inputCol="assembled", outputCol="features", withMean=False, withStd=True),
               "minmax": MinMaxScaler(inputCol="assembled", outputCol="features"), None: None}
    if scaling not in scalers:
        raise ValueError(f"unknown scaling {scaling!r}: use standard, minmax or None")
    stages: list = []
    inputs = list(numeric)
    if numeric:
        stages.append(ColumnImputer(inputCols=list(numeric), strategy="median"))
        if clip_outliers:
            stages.append(IqrClipper(inputCols=list(numeric)))
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        if encoding == "onehot":
            encoded = [f"{c}_vec" for c in categorical]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
            indexed = encoded
        inputs += indexed
    if balanced:
        stages.append(BalancedWeights())
    stages.append(VectorAssembler(inputCols=inputs, outputCol="assembled" if scaling else "features", handleInvalid="keep"))
    if scaling:
        stages.append(scalers[scaling])
    return Pipeline(stages=stages)


@dataclass
class Prepared:
    """Fitted preparation and the cached feature table it gave for training."""

    model: PipelineModel
    train: DataFrame
    names: list[str]

    def release(self) -> None:
        self.train.unpersist()


def deal_out(table: DataFrame, *key: str) -> DataFrame:
    """A checkpointed table in as many partitions as an iterative fit should have tasks: a share for every core.

    A small table was coalesced into few partitions, but fits are bound by computing. A large one has as many as its last
    shuffle, and each of a fit's hundreds of jobs pays for every task: with its start, its result, and the sums of all
    nodes or centres that it hands on. Cores get further shares only when a share has more than ``MOST_ROWS`` rows.
    """
    cores, rows, have = table.sparkSession.sparkContext.defaultParallelism, table.count(), table.rdd.getNumPartitions()
    most = cores * max(1, -(-rows // (cores * MOST_ROWS)))
    wanted = min(most, -(-rows // ROWS_PER_TASK))
    if have < wanted:
        return table.repartition(wanted, *key)
    return table.coalesce(most) if have > most else table


def prepare(train: DataFrame, stages: Pipeline | None = None, keep: Sequence[str] = (S.KEY, "label"),
            resample: str | None = None) -> Prepared:
    """Fit the preparation once and keep only what classifiers read, so every fit starts from vectors.

    ``resample`` balances the encoded training rows: smote, adasyn, oversample or undersample.
    The vectors are checkpointed: iterative fits plan hundreds of small jobs, and each would drag the lineage along.
    """
    raw = train.persist(StorageLevel.MEMORY_AND_DISK)
    model = (stages or preparation()).fit(raw)
    out = model.transform(raw)
    columns = [*keep, "features", *(["weight"] if "weight" in out.columns else [])]
    table = cut_lineage(out.select(*columns))
    raw.unpersist()
    if resample:
        table = cut_lineage(balance(table, resample))
    table = deal_out(table, keep[0]).persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(model, table, feature_names(out))


def scores(df: DataFrame, keep: Sequence[str] = (S.KEY, "label")) -> DataFrame:
    """(kept columns, score, prediction) of a classifier's output."""
    return df.select(*keep, positive_probability().alias("score"), F.col("prediction").cast("int").alias("prediction"))


def fit_scores(train: DataFrame, rows: DataFrame, estimator: Estimator, stages: Pipeline | None = None) -> DataFrame:
    """Train on one table and score another."""
    prepared = prepare(train, stages)
    model = estimator.fit(prepared.train)
    prepared.release()
    return scores(model.transform(prepared.model.transform(rows)))


# --- tuning --------------------------------------------------------------------------------------------------------

def grid(estimator: Estimator, lists: Mapping[str, Sequence[object]]) -> list[dict]:
    """Every combination of the parameter lists as Spark param maps."""
    names = list(lists)
    return [{estimator.getParam(n): v for n, v in zip(names, combo)} for combo in product(*lists.values())]


def random_grid(estimator: Estimator, lists: Mapping[str, Sequence[object]], n: int, seed: int = S.SEED) -> list[dict]:
    """n combinations drawn without repetition."""
    every = grid(estimator, lists)
    return random.Random(seed).sample(every, min(n, len(every)))


def cross_validate(train: DataFrame, estimator: Estimator, candidates: list[dict], key: str = S.KEY, folds: int = 3,
                   parallelism: int = 4, seed: int = S.SEED) -> tuple[Transformer, DataFrame]:
    """The refitted best model and (params, mean_auc, std_auc, best) per candidate over stratified folds."""
    spark = train.sparkSession
    marked = deal_out(cut_lineage(folds_stratified(train, key, ["label"], folds, seed)), key).persist(StorageLevel.MEMORY_AND_DISK)
    judge = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0)
    search = CrossValidator(estimator=estimator, estimatorParamMaps=candidates, evaluator=judge, numFolds=folds,
                            foldCol="fold", parallelism=parallelism, seed=seed)
    fitted = search.fit(marked)
    marked.unpersist()
    names = [", ".join(f"{p.name}={v}" for p, v in c.items()) for c in candidates]
    best = max(range(len(names)), key=lambda i: fitted.avgMetrics[i])
    table = spark.createDataFrame(
        [(names[i], float(fitted.avgMetrics[i]), float(fitted.stdMetrics[i]), i == best) for i in range(len(names))],
        "params string, mean_auc double, std_auc double, best boolean")
    return fitted.bestModel, table


Fitted = Callable[[DataFrame], DataFrame]


def fold_scores(df: DataFrame, fit: Callable[[DataFrame], Fitted], fold: str = "fold", expanding: bool = False,
                metric: str = "roc_auc") -> DataFrame:
    """(fold, score) of a model over any fold column: stratified, plain, by time or by the caller's own rule.

    ``fit(train)`` gives a function that scores rows to (label, score, prediction). With ``expanding`` a fold is tested on
    what the folds below it taught, so the first one only trains. ``metric`` is any column of ``compare_models``; all folds
    are judged in one pass. ``metrics.stability`` takes the result.
    """
    df = cut_lineage(df)  # read once per fold
    numbers = sorted(r[0] for r in df.select(fold).where(F.col(fold).isNotNull()).distinct().collect())  # a row per fold
    parts = None
    for i in numbers[1:] if expanding else numbers:
        train = df.where(F.col(fold) < i if expanding else F.col(fold) != i)
        scored = fit(train)(df.where(F.col(fold) == i)).select("label", "score", "prediction", F.lit(str(i)).alias("model"))
        parts = scored if parts is None else parts.unionByName(scored)
    if parts is None:
        raise ValueError(f"{fold} has no fold to test on")
    return compare_models(parts).select(F.col("model").cast("int").alias(fold), F.col(metric).alias("score"))


def fitting(estimator: Estimator, stages: Pipeline | None = None) -> Callable[[DataFrame], Fitted]:
    """How ``fold_scores`` fits a classifier with its preparation."""
    def fit(train: DataFrame) -> Fitted:
        prepared = prepare(train, stages)
        model = estimator.fit(prepared.train)
        prepared.release()
        return lambda rows: scores(model.transform(prepared.model.transform(rows)), ["label"])

    return fit


def compare_feature_sets(train: DataFrame, test: DataFrame, sets: Mapping[str, tuple[Sequence[str], Sequence[str]]],
                         estimator: Estimator) -> DataFrame:
    """One metrics row per (numeric, categorical) feature set."""
    parts = None
    for name, (numeric, categorical) in sets.items():
        scored = fit_scores(train, test, estimator, preparation(numeric, categorical)).withColumn("model", F.lit(name))
        parts = scored if parts is None else parts.unionByName(scored)
    return compare_models(parts)


# --- segments ------------------------------------------------------------------------------------------------------

def segments(df: DataFrame, features: Sequence[str] = ("tenure", "MonthlyCharges"), k: int = 4, starts: int = 10,
             seed: int = S.SEED, out: str = "segment") -> DataFrame:
    """k-means on standardised features, best of several starts, numbered by rising mean of the first feature.

    Rows with a null feature stay in the table with a null segment.
    """
    complete = df.dropna(subset=list(features))
    vectors = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)])
    scaler = vectors.fit(complete)
    table = deal_out(cut_lineage(scaler.transform(complete).select("features", features[0]))).persist(StorageLevel.MEMORY_AND_DISK)
    table.count()
    with ThreadPoolExecutor(4) as pool:  # independent starts on one cached table
        fits = list(pool.map(lambda i: KMeans(k=k, seed=seed + i, featuresCol="features", predictionCol="_cluster").fit(table),
                             range(starts)))
    best = min(fits, key=lambda m: m.summary.trainingCost)
    order = [r["_cluster"] for r in best.transform(table).groupBy("_cluster").agg(F.avg(features[0]).alias("m"))
             .orderBy("m", "_cluster").collect()]
    table.unpersist()
    # An incomplete row has no place in the space: score it at the origin, then blank its segment.
    filled = df.withColumns({f"_f{i}": F.col(c) for i, c in enumerate(features)}).fillna(0, subset=list(features))
    number = F.array_position(F.array(*[F.lit(c) for c in order]), F.col("_cluster")).cast("int") - 1
    present = F.lit(True)
    for i in range(len(features)):
        present = present & F.col(f"_f{i}").isNotNull()
    placed = best.transform(scaler.transform(filled)).withColumn(out, F.when(present, number))
    return placed.select(*[F.col(f"_f{features.index(c)}").alias(c) if c in features else F.col(c) for c in df.columns], out)


def fit_all(table: DataFrame, estimators: Mapping[str, Estimator], threads: int = 3) -> dict[str, Transformer]:
    """Independent fits on one cached table, submitted side by side."""
    with ThreadPoolExecutor(threads) as pool:
        return dict(zip(estimators, pool.map(lambda e: e.fit(table), estimators.values())))


# --- train, compare, select ----------------------------------------------------------------------------------------

def train_select(train: DataFrame, test: DataFrame, estimators: Mapping[str, Estimator], stages: Pipeline | None = None,
                 metric: str = "roc_auc", resample: str | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit every classifier on one cached feature table, compare on the test rows, return the best and all metrics."""
    prepared = prepare(train, stages, resample=resample)
    fitted = fit_all(prepared.train, estimators)
    prepared.release()
    vectors = prepared.model.transform(test).select(S.KEY, "label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    parts = None
    for name, model in fitted.items():
        part = scores(model.transform(vectors)).withColumn("model", F.lit(name))
        parts = part if parts is None else parts.unionByName(part)
    rows = compare_models(parts).collect()
    vectors.unpersist()
    best = max(sorted(rows, key=lambda r: r["model"]), key=lambda r: r[metric])["model"]
    table = train.sparkSession.createDataFrame([(*r, r["model"] == best) for r in rows],
                                               "model string, accuracy double, precision double, recall double, f1 double, "
                                               "roc_auc double, pr_auc double, selected boolean")
    return PipelineModel([*prepared.model.stages, fitted[best]]), table



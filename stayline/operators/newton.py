"""Logistic models of all folds and penalties at once.

Cross-validating k folds with m penalties is k x m fits, each a chain of jobs of its own. Here all of them take their
Newton step together: one pass over the rows adds up loss, gradient and curvature of every model, a row counting in the
models whose fold is not its own. Jobs depend on the steps, not on k x m. Sums have the size of the models: the driver
sees k x m x (d + 1)^2 numbers a step, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.metrics import compare_models
from stayline.plans.matrices import block, fetched, summed

STEPS = 50
TOLERANCE = 1e-9  # of a coefficient
HALVINGS = 30


@dataclass
class FoldModels:
    """weights[f, p]: intercept and coefficients of the model that did not see ``folds[f]``, at ``penalties[p]``."""

    folds: list[int]
    penalties: list[float]
    weights: np.ndarray
    steps: int
    converged: np.ndarray


def _rows(df: DataFrame, features: str, label: str, fold: str) -> DataFrame:
    kind = df.schema[features].dataType.typeName()
    x = F.col(features) if kind == "array" else vector_to_array(features)
    y, part = F.col(label).cast("double"), F.col(fold).cast("int")
    return df.select(x.cast("array<double>").alias("x"), y.alias("y"), part.alias("fold")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("fold").isNotNull()
        & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))


def fit_folds(df: DataFrame, penalties: Sequence[float] = (0.0,), features: str = "features", label: str = "label",
              fold: str = "fold", steps: int = STEPS) -> FoldModels:
    """Fit mean log loss + penalty / 2 x squared coefficients (not the intercept) for every fold left out.

    ``features`` is a vector or an array of numbers, taken as it is: scale before. Rows with a null label or fold, or
    with a null or non-finite feature, teach nothing. Without a penalty collinear features get the smallest step; where
    classes can be separated there is no optimum, and ``converged`` says so after ``steps``. A single fold leaves no rows
    to learn from: ValueError, as for a table without usable rows.
    """
    rows = _rows(df, features, label, fold).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())  # a row per fold
        if len(folds) < 2:
            raise ValueError(f"{fold} has {len(folds)} folds with usable rows: at least 2 are needed")
        size = rows.select(F.size("x").alias("n")).first()["n"]
        if rows.where(F.size("x") != size).limit(1).count():
            raise ValueError(f"{features} differs in length")
        return _newton(rows, folds, [float(p) for p in penalties], size + 1, steps)
    finally:
        rows.unpersist()


def _newton(rows: DataFrame, folds: list[int], penalties: list[float], size: int, steps: int) -> FoldModels:
    held = np.repeat(np.array(folds), len(penalties))
    ridge = np.tile(np.array(penalties), len(folds))[:, None] * np.r_[0.0, np.ones(size - 1)]
    models = len(held)
    at = np.zeros((models, size))

    def measure(where: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def local(batch: pa.RecordBatch) -> np.ndarray:
            x = np.column_stack([np.ones(batch.num_rows), block(batch, 0, size - 1)])
            y = batch.column(1).to_numpy()[:, None]
            taught = batch.column(2).to_numpy()[:, None] != held
            z = x @ where.T
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
            loss = ((np.logaddexp(0.0, z) - y * z) * taught).sum(0)
            curve = p * (1.0 - p) * taught
            second = np.stack([(x.T * curve[:, k]) @ x for k in range(models)])
            return np.concatenate([taught.sum(0)[:, None], loss[:, None], ((p - y) * taught).T @ x,
                                   second.reshape(models, -1)], axis=1)

        sums = fetched(summed(rows, local)).reshape(models, -1)
        n = sums[:, :1]
        value = sums[:, 1] / n[:, 0] + (ridge * where * where).sum(1) / 2
        slope = sums[:, 2:2 + size] / n + ridge * where
        bend = sums[:, 2 + size:].reshape(models, size, size) / n[:, :, None]
        bend = bend + np.einsum("ki,ij->kij", ridge, np.eye(size))
        return value, slope, bend

    value, slope, bend = measure(at)
    done, halved, taken = np.zeros(models, bool), np.zeros(models, int), 0
    while taken < steps and not done.all():
        move = np.stack([np.linalg.lstsq(b, s, rcond=1e-12)[0] for b, s in zip(bend, slope)])
        trial = at - np.where(done, 0.0, 0.5 ** halved)[:, None] * move
        new_value, new_slope, new_bend = measure(trial)
        taken += 1
        better = ~done & (new_value <= value + 1e-13 * np.abs(value))
        small = np.abs(trial - at).max(1) <= TOLERANCE * np.maximum(1.0, np.abs(at).max(1))
        halved = np.where(better, 0, np.minimum(halved + 1, HALVINGS))
        at[better], value[better], slope[better], bend[better] = (
            trial[better], new_value[better], new_slope[better], new_bend[better])
        done |= small
    return FoldModels(folds, penalties, at.reshape(len(folds), len(penalties), size), taken,
                      done.reshape(len(folds), len(penalties)))


def held_out_scores(df: DataFrame, models: FoldModels, features: str = "features", fold: str = "fold") -> DataFrame:
    """The table with ``scores``: per penalty the probability by the model that did not see the row's fold.

    Null for a row without features or in a fold that was not fitted.
    """
    where = {f: i for i, f in enumerate(models.folds)}
    weights = models.weights

    @F.pandas_udf("array<double>")
    def score(x: pd.Series, part: pd.Series) -> pd.Series:
        out: list = [None] * len(x)
        for f in part.dropna().unique():
            if int(f) not in where:
                continue
            rows = np.flatnonzero((part == f).to_numpy() & x.notna().to_numpy())
            if len(rows):
                values = np.stack(x.iloc[rows].to_list())
                w = weights[where[int(f)]]
                p = 1.0 / (1.0 + np.exp(-np.clip(w[:, 0] + values @ w[:, 1:].T, -500, 500)))
                for r, s in zip(rows.tolist(), p):
                    out[r] = s
        return pd.Series(out, dtype=object)

    kind = df.schema[features].dataType.typeName()
    x = F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)
    return df.withColumn("scores", score(x, F.col(fold).cast("int")))


def compare_penalties(df: DataFrame, penalties: Sequence[float], features: str = "features", label: str = "label",
                      fold: str = "fold", metric: str = "roc_auc") -> DataFrame:
    """(penalty, mean_score, std_score, best) of every penalty over the folds, all judged in one pass.

    ``metric`` is any column of ``compare_models``. Of equal means the first penalty is best.
    """
    models = fit_folds(df, penalties, features, label, fold)
    scored = held_out_scores(df, models, features, fold).where(F.col(label).isNotNull() & F.col("scores").isNotNull())
    long = scored.select(F.col(label).cast("int").alias("label"), F.col(fold).cast("int").alias("fold"),
                         F.posexplode("scores").alias("at", "score")).select(
        "label", "score", (F.col("score") > 0.5).cast("int").alias("prediction"),
        F.concat_ws("|", "at", "fold").alias("model"))
    table = compare_models(long).groupBy(F.split("model", r"\|")[0].cast("int").alias("at")).agg(
        F.avg(metric).alias("mean_score"), F.stddev_pop(metric).alias("std_score"))
    rows = {r["at"]: r for r in table.collect()}  # a row per penalty
    best = max(rows, key=lambda i: (rows[i]["mean_score"], -i))
    return df.sparkSession.createDataFrame(
        [(float(p), rows[i]["mean_score"], rows[i]["std_score"], i == best) for i, p in enumerate(penalties)],
        "penalty double, mean_score double, std_score double, best boolean")

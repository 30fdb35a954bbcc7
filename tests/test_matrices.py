"""Sums of arrays over tasks, wide correlation, logistic models of all folds and penalties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from stayline.operators import newton, wide
from stayline.plans import matrices


def test_sums_are_those_of_all_rows(spark):
    rows = spark.range(1000).repartition(7).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))

    def local(batch):
        x = matrices.block(batch, 0, 2)
        return np.concatenate([x.sum(0), np.zeros(700)])

    found = matrices.fetched(matrices.summed(rows, local))
    assert len(found) == 702 and found[:2].tolist() == [499500.0, 1000.0]
    assert matrices.fetched(matrices.summed(rows.where("false"), local)) is None


def test_correlation_of_500_columns_with_nulls(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(400, 20))
    x = base @ rng.normal(size=(20, 500)) + rng.normal(size=(400, 500)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(500)])
    df = spark.createDataFrame(frame.reset_index(drop=True).apply(list, axis=1).to_frame("v"), "v array<double>").select(
        *[F.col("v")[i].alias(f"c{i}") for i in range(500)])
    found = wide.correlation_blocks(df).toPandas()
    assert len(found) == 250_000
    got = found.pivot(index="column_a", columns="column_b", values="r").loc[frame.columns, frame.columns].to_numpy()
    want = frame.corr().to_numpy()
    assert np.abs(got - want).max() < 1e-8


def test_correlation_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 5.0, None, 1.0, "x"), (2.0, 5.0, None, inf, "y"), (4.0, 5.0, 3.0, 2.0, "z"), (nan, 5.0, 4.0, 1.0, "z")]
    df = spark.createDataFrame(rows, "a double, `flat.one` double, few double, wild double, t string")
    got = {(r["column_a"], r["column_b"]): (r["n"], r["r"]) for r in
           wide.correlation_blocks(df, ["a", "flat.one", "few", "wild"]).collect()}
    assert len(got) == 16
    assert got["a", "a"] == (3, pytest.approx(1.0))
    assert got["a", "flat.one"] == (3, None) and got["flat.one", "a"] == (3, None)
    assert got["a", "few"] == (1, None)
    assert got["a", "wild"][0] == 3 and got["a", "wild"][1] != got["a", "wild"][1]
    assert wide.correlation_blocks(df.where("false"), ["a", "few"]).collect() == []


@pytest.fixture(scope="module")
def taught(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 4))
    y = (rng.random(1500) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5, 0.0] - 0.3)))).astype(int)
    fold = rng.integers(0, 3, 1500)
    rows = [([float(v) for v in a], int(b), int(c)) for a, b, c in zip(x, y, fold)]
    return spark.createDataFrame(rows, "features array<double>, label int, fold int").repartition(5).cache()


def test_models_equal_single_fits(taught):
    penalties = [0.0, 0.01, 0.3]
    models = newton.fit_folds(taught, penalties)
    assert models.folds == [0, 1, 2] and models.converged.all()
    table = taught.withColumn("features", array_to_vector("features"))
    for f in models.folds:
        for i, p in enumerate(penalties):
            single = LogisticRegression(regParam=p, standardization=False, maxIter=500, tol=1e-14).fit(
                table.where(F.col("fold") != f))
            want = [single.intercept, *single.coefficients]
            assert np.abs(models.weights[f, i] - want).max() < 1e-6


def test_passes_do_not_grow_with_models(taught, monkeypatch):
    passes = []
    real = newton.summed
    monkeypatch.setattr(newton, "summed", lambda *a: passes.append(1) or real(*a))
    newton.fit_folds(taught, [0.1])
    one = len(passes)
    passes.clear()
    newton.fit_folds(taught, [0.1, 0.2, 0.4, 0.8, 1.6, 3.2])
    assert len(passes) <= one + 2


def test_odd_rows_teach_nothing(spark, taught):
    odd = spark.createDataFrame([(None, 1, 0), ([1.0, None, 0.0, 0.0], 1, 1), ([float("inf"), 0.0, 0.0, 0.0], 0, 2),
                                 ([9.0, 9.0, 9.0, 9.0], None, 1), ([9.0, 9.0, 9.0, 9.0], 1, None)], taught.schema)
    a, b = newton.fit_folds(taught, [0.1]), newton.fit_folds(taught.unionByName(odd), [0.1])
    assert np.abs(a.weights - b.weights).max() < 1e-9
    scores = newton.held_out_scores(odd, a).collect()
    assert scores[0]["scores"] is None and scores[4]["scores"] is None and len(scores[3]["scores"]) == 1
    with pytest.raises(ValueError):
        newton.fit_folds(taught.where("fold = 1"), [0.1])
    with pytest.raises(ValueError):
        newton.fit_folds(taught.where("false"), [0.1])


def test_separable_classes_end(spark):
    rows = [([float(i)], int(i >= 20), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "features array<double>, label int, fold int")
    models = newton.fit_folds(df, [0.0, 0.1], steps=20)
    assert models.steps <= 20 and models.converged[:, 1].all() and np.isfinite(models.weights).all()


def test_penalties_are_compared(taught):
    rows = newton.compare_penalties(taught, [0.01, 100.0]).collect()
    assert [r["penalty"] for r in rows] == [0.01, 100.0]
    assert sum(r["best"] for r in rows) == 1 and rows[0]["mean_score"] > 0.8

"""Second-order boosting: sums against a loop over rows, growth, missing values, saving."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import boosting as B
from stayline.operators.metrics import roc_auc


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    a, b, c = rng.normal(size=(3, 600)).round(1)
    y = ((a > 0.2) ^ (b > 0)) | (rng.random(600) < 0.1)
    rows = [(i, None if i % 29 == 0 else float(a[i]), float("nan") if i % 31 == 0 else float(b[i]), float(c[i]), float(y[i])) for i in range(600)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label double").repartition(4).cache()


def brute_tree(x, g, h, depth, l2, least_weight):
    """Leaf of every row by an exhaustive search over the bins."""
    out = np.zeros(len(g))

    def grow(rows, left):
        best = (0.0, None)
        if left:
            for f in range(x.shape[1]):
                for cut in range(int(x.max())):
                    lo = rows[x[rows, f] <= cut]
                    hi = rows[x[rows, f] > cut]
                    if len(lo) and len(hi) and h[lo].sum() >= least_weight and h[hi].sum() >= least_weight:
                        gain = round(sum(s * g[r].sum() ** 2 / (h[r].sum() + l2) for r, s in ((lo, 1), (hi, 1), (rows, -1))) / 2, 9)
                        if gain > best[0]:
                            best = (gain, (lo, hi))
        if best[1] is None:
            out[rows] = -g[rows].sum() / (h[rows].sum() + l2)
        else:
            for part in best[1]:
                grow(part, left - 1)

    grow(np.arange(len(g)), depth)
    return out


def test_trees_equal_an_exhaustive_search(data):
    model = B.fit_boosted(data, ["a", "b", "c"], rounds=3, depth=3, rate=0.5, bins=12)
    rows = model.score(data).select("id", model.bins().alias("bins"), "label", "margin").orderBy("id").collect()
    x, y = np.array([r["bins"] for r in rows]), np.array([r["label"] for r in rows])
    margin = np.zeros(len(y))
    for _ in range(3):
        p = 1 / (1 + np.exp(-margin))
        margin = margin + 0.5 * brute_tree(x, p - y, p * (1 - p), 3, 1.0, 1.0)
    assert np.array([r["margin"] for r in rows]) == pytest.approx(margin, abs=1e-9)


def test_more_rounds_fit_better_and_nulls_are_scored(data):
    areas = [roc_auc(B.fit_boosted(data, ["a", "b", "c"], rounds=n, depth=3, bins=32).score(data)).first()["roc_auc"] for n in (1, 12)]
    assert 0.6 < areas[0] < areas[1] and areas[1] > 0.85
    model = B.fit_boosted(data, ["a", "b"], rounds=2, depth=2)
    odd = data.limit(5).withColumns({"a": F.lit(None).cast("double"), "b": F.lit(float("nan")), "label": F.lit(None).cast("double")})
    assert model.score(odd).where("score > 0 and score < 1").count() == 5
    unlabelled = data.withColumn("label", F.when(F.col("id") % 2 == 0, F.col("label")))
    edges = B.fit_boosted(data, ["a"], rounds=0).edges
    assert B.fit_boosted(unlabelled, ["a"], rounds=1, depth=1).edges == edges


def test_models_survive_text_and_do_not_depend_on_partitions(data):
    model = B.fit_boosted(data, ["a", "b", "c"], rounds=2, depth=3)
    again = B.BoostedTrees.from_json(model.to_json())
    assert again == model
    other = B.fit_boosted(data.repartition(7), ["a", "b", "c"], rounds=2, depth=3, edges=model.edges)
    assert [t.splits for t in other.trees] == [t.splits for t in model.trees]


def test_nothing_to_split(spark, data):
    none = B.fit_boosted(data.where("id < 0"), ["a"], rounds=1, depth=2)
    assert none.score(data).where("score = 0.5").count() == 600
    same = B.fit_boosted(data.withColumn("a", F.lit(1.0)), ["a"], rounds=1, depth=2, rate=1.0)
    assert same.trees[0].splits == {} and list(same.trees[0].leaves) == [0]

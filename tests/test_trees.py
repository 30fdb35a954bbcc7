"""Contributions of single rows to tree scores, against all subsets of features."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayline.operators import trees

NAMES = ["a", "b", "c", "kind_index", "d", "e"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        a, b, c, d, e = rng.normal(size=5).round(2).tolist()
        kind = "uvwxyz"[int(rng.integers(6))]
        rows.append((i, a, b, c, d, e, kind, float(a + (kind in "uw") - b * (c > 0) + rng.normal() * 0.3 > 0.3)))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, kind string, label double")
    stages = Pipeline(stages=[StringIndexer(inputCol="kind", outputCol="kind_index"), VectorAssembler(inputCols=NAMES, outputCol="features")])
    return stages.fit(df).transform(df).select("id", "label", "features").cache()


ESTIMATORS = {"dt": lambda: DecisionTreeClassifier(maxDepth=6),
              "rf": lambda: RandomForestClassifier(numTrees=6, maxDepth=5, seed=1, featureSubsetStrategy="all"),
              "gbt": lambda: GBTClassifier(maxIter=4, maxDepth=4, seed=1)}


def brute(spark, model, x):
    """The Shapley formula over all subsets of features, each valued by a walk through the nodes."""
    nodes, counts = {}, not type(model).__name__.startswith("GBT")
    for r in trees.node_rows(spark, model).collect():
        nodes.setdefault(r["tree"], {})[r["id"]] = r

    def walk(tree, node, known):
        if node["left"] < 0:
            return node["stats"][1] / sum(node["stats"]) if counts else node["prediction"]
        left, right = tree[node["left"]], tree[node["right"]]
        if node["feature"] in known:
            v = x[node["feature"]]
            goes = v in node["split"] if node["categories"] >= 0 else v <= node["split"][0]
            return walk(tree, left if goes else right, known)
        n, m = ((sum(k["stats"]) if counts else k["count"]) for k in (left, right))
        return (n * walk(tree, left, known) + m * walk(tree, right, known)) / (n + m)

    weights = [1 / len(nodes)] * len(nodes) if counts else model.treeWeights
    value = {s: sum(w * walk(t, t[0], set(s)) for w, (_, t) in zip(weights, sorted(nodes.items())))
             for k in range(len(x) + 1) for s in combinations(range(len(x)), k)}
    n, out = len(x), []
    for i in range(n):
        others = [j for j in range(n) if j != i]
        out.append(sum(factorial(k) * factorial(n - k - 1) / factorial(n) * (value[tuple(sorted((*s, i)))] - value[s])
                       for k in range(n) for s in combinations(others, k)))
    return value[()], out


@pytest.mark.parametrize("name", ESTIMATORS)
def test_contributions_equal_all_subsets(spark, vectors, name):
    model = ESTIMATORS[name]().fit(vectors)
    rows = trees.explain_rows(vectors.where("id < 6").withColumn("x", vector_to_array("features")), model, ["id", "x"]).collect()
    assert len(rows) == 6
    for r in rows:
        base, parts = brute(spark, model, r["x"])
        assert r["base"] == pytest.approx(base, abs=1e-12)
        assert r["contributions"] == pytest.approx(parts, abs=1e-10)


@pytest.mark.parametrize("name", ESTIMATORS)
def test_contributions_sum_to_the_score(vectors, name):
    model = ESTIMATORS[name]().fit(vectors)
    scored = model.transform(vectors).withColumn("score", vector_to_array("rawPrediction" if name == "gbt" else "probability")[1])
    for part in (trees.PART_LEAVES, 10):  # also with the model in many parts
        rows = trees.explain_rows(scored, model, ["id", "score"], part_leaves=part)
        gap = rows.select(F.max(F.abs(F.col("base") - F.col("score") + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b))))
        assert rows.count() == 400 and gap.first()[0] < 1e-12


def test_rows_without_vector_and_values_that_are_no_number(spark, vectors):
    model = ESTIMATORS["rf"]().fit(vectors)
    odd = vectors.where("id < 2").unionByName(spark.createDataFrame([(-1, 0.0, None)], vectors.schema))
    rows = {r["id"]: r["contributions"] for r in trees.explain_rows(odd, model, ["id"]).collect()}
    assert rows[-1] is None and len(rows[0]) == len(NAMES)
    parts, base = trees.leaf_parts(spark, model)
    x = np.array([[np.nan] * 3 + [99.0] + [np.nan] * 2])
    total = sum(trees.contributions_of(p, x) for p in parts)
    assert np.isfinite(total).all()
    assert trees.explain_rows(vectors.limit(0), model, ["id"]).count() == 0


def test_named_contributions_and_columns(vectors):
    model = ESTIMATORS["dt"]().fit(vectors)
    long = trees.tree_contributions(vectors.where("id < 5"), model, ["id"], ["a", "b_vec_x", "b_vec_y", "kind_index", "d", "e"])
    assert long.count() == 30
    sums = trees.by_column(long, ["id"], ["b"])
    assert {r["feature"] for r in sums.collect()} == {"a", "b", "kind_index", "d", "e"}
    both = long.where("feature like 'b_vec%'").groupBy("id").agg(F.sum("contribution").alias("s")).join(
        sums.where("feature = 'b'"), "id").where("abs(s - contribution) > 1e-12")
    assert both.count() == 0


def test_a_tree_that_is_one_leaf(spark, vectors):
    model = DecisionTreeClassifier(maxDepth=0).fit(vectors)
    row = trees.explain_rows(vectors.where("id = 0"), model, ["id"]).first()
    assert row["contributions"] == [0.0] * 6
    share = vectors.agg(F.avg("label")).first()[0]
    assert row["base"] == pytest.approx(share)


def test_three_classes_are_refused(spark, vectors):
    model = DecisionTreeClassifier().fit(vectors.withColumn("label", F.col("id") % 3.0))
    with pytest.raises(ValueError):
        trees.leaf_parts(spark, model)

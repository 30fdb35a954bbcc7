"""Fitted values per group: target statistics in hash order, deviations from group means, saving and loading."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from stayline.operators import group_models as G
from stayline.plans import ordered

ROWS = "id string, a string, b int, label double, _id string, category string"


def rows_of(n, seed=1):
    rng = random.Random(seed)
    return [(str(i), rng.choice(["hot"] * 6 + ["x", "y", None]), rng.choice([1, 2, None]), rng.choice([0.0, 1.0, 1.0, None]), "c", "d")
            for i in range(n)]


def brute(rows, prior, weight, seed=42):
    """By id: values of a and b from the rows before, in hash order."""
    order = sorted({r[0] for r in rows if r[0] is not None}, key=lambda k: (hashlib.md5(f"{k}:{seed}".encode()).hexdigest(), k))
    out, sums, counts = [], defaultdict(float), defaultdict(int)
    for key in order:
        own = [r for r in rows if r[0] == key]
        for r in own:
            out.append((*r[:4], *[(sums[c, r[c]] + prior * weight) / (counts[c, r[c]] + weight) for c in (1, 2)]))
        for r in own:
            for c in (1, 2):
                if r[3] is not None:
                    sums[c, r[c]] += r[3]
                    counts[c, r[c]] += 1
    return out + [(*r[:4], prior, prior) for r in rows if r[0] is None]


def plain(rows):
    return sorted(((*r[:4], *[round(v, 9) for v in r[4:]]) for r in rows), key=str)


@pytest.mark.parametrize("prior, weight", [(None, 1.0), (0.25, 3.0)])
def test_ordered_statistics_equal_a_loop(spark, prior, weight):
    rows = [*rows_of(400), ("7", "hot", 2, 1.0, "c", "d"), ("7", "new", None, 0.0, "c", "d"), (None, "hot", 1, 1.0, "c", "d")]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got = G.ordered_target_encode(df, "id", ["a", "b"], prior=prior, weight=weight)
    assert got.columns == [*df.columns, "a_target", "b_target"]
    known = [r[3] for r in rows if r[3] is not None]
    want = brute(rows, sum(known) / len(known) if prior is None else prior, weight)
    assert plain(got.select("id", "a", "b", "label", "a_target", "b_target").collect()) == plain(want)


def test_no_row_sees_its_own_label(spark):
    df = spark.createDataFrame(rows_of(200), ROWS)
    own = F.col("id") == "17"
    other = df.withColumn("label", F.when(own, 1 - F.coalesce("label", F.lit(0.0))).otherwise(F.col("label")))
    values = [G.ordered_target_encode(d, "id", ["a"], prior=0.5).where(own).first()["a_target"] for d in (df, other)]
    assert values[0] == values[1]


def test_a_hot_category_is_spread(spark):
    """Rows of one category are windowed by (category, hash bucket), not as a whole."""
    df = spark.range(2000).select(F.col("id").cast("string"), F.lit("hot").alias("a"), F.lit(1).alias("b"), (F.col("id") % 2.0).alias("label"))
    text = G.ordered_target_encode(df, "id", ["a"])._jdf.queryExecution().toString()
    windows = [line for line in text.split("\n") if "windowspecdefinition(" in line and "_id" in line]
    assert windows and all("_b#" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)
    assert ordered.HASH_DIGITS == 4


def test_encoder_for_later_rows(spark, tmp_path):
    train = spark.createDataFrame(rows_of(300), ROWS)
    later = spark.createDataFrame([("a1", "hot", 1, None, "", ""), ("a2", "never", None, None, "", ""), ("a3", None, 2, None, "", "")], ROWS)
    model = Pipeline(stages=[G.TargetEncoder(inputCols=["a", "b"], weight=2.0)]).fit(train)
    model.write().overwrite().save(str(tmp_path / "m"))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        got = {r["id"]: r for r in m.transform(later).collect()}
        prior = train.agg(F.avg("label")).first()[0]
        hot = [r[3] for r in rows_of(300) if r[1] == "hot" and r[3] is not None]
        assert got["a1"]["a_target"] == pytest.approx((sum(hot) + 2 * prior) / (len(hot) + 2))
        assert got["a2"]["a_target"] == pytest.approx(prior) and got["a3"]["a_target"] != pytest.approx(prior)
        assert len(got) == 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], ROWS)
    assert G.ordered_target_encode(none, "id", ["a"]).count() == 0
    model = G.TargetEncoder(inputCols=["a"]).fit(none)
    assert model.transform(spark.createDataFrame(rows_of(3), ROWS)).where("a_target = 0").count() == 3


def test_a_million_groups(spark, tmp_path):
    df = spark.range(2_000_000).select((F.col("id") % 1_000_000).alias("g"), F.col("id").cast("double").alias("v"))
    G.GroupMeanDeviation(inputCol="v", groupCol="g", outputCol="dev").fit(df).save(str(tmp_path / "m"))
    out = G.GroupMeanDeviationModel.load(str(tmp_path / "m")).transform(df)
    assert out.where("abs(dev) = 500000").count() == 2_000_000


def test_deviation_of_unseen_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), ("b", None)], "g string, v double")
    model = G.GroupMeanDeviation(inputCol="v", groupCol="g", outputCol="dev").fit(df)
    got = sorted(model.transform(df.unionByName(spark.createDataFrame([("new", 1.0)], df.schema))).collect(), key=str)
    assert [(r["g"], r["dev"]) for r in got] == [("a", -1.0), ("a", 1.0), ("b", None), ("new", None), (None, None)]

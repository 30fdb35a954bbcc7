import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import resample, sampling
from stayline.operators.neighbors import Leaves, nearest, nearest_rows


def brute(queries, base, k):
    """{key: [(neighbour, d2)]} by comparing everything."""
    out = {}
    for qk, q in queries:
        dist = sorted(((float(((np.array(q) - np.array(b)) ** 2).sum()), bk) for bk, b in base if bk != qk))
        out[qk] = [(bk, d) for d, bk in dist[:k]]
    return out


def points(seed, n, dims, hot=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        p = [0.5] * dims if rng.random() < hot else [float(v) for v in np.round(rng.normal(size=dims), 2)]
        rows.append((f"k{i:04d}", p))
    return rows


def table(spark, rows):
    dims = len(rows[0][1])
    return spark.createDataFrame([(k, *p) for k, p in rows], "id string, " + ", ".join(f"f{i} double" for i in range(dims)))


@pytest.mark.parametrize("dims,hot,leaf_rows", [(2, 0.0, 40), (2, 0.4, 25), (4, 0.1, 60), (1, 0.0, 10), (2, 0.0, 5000)])
def test_nearest_is_exact(spark, dims, hot, leaf_rows):
    rows = points(3, 400, dims, hot)
    df = table(spark, rows).repartition(4)
    got = nearest(df, df, "id", [f"f{i}" for i in range(dims)], 5, leaf_rows).collect()
    want = brute(rows, rows, 5)
    assert len(got) == 400
    for r in got:
        assert [n["neighbor"] for n in r["near"]] == [b for b, _ in want[r["key"]]]


def test_nearest_of_other_table(spark):
    base, queries = points(5, 300, 3), [(f"q{k}", p) for k, p in points(6, 50, 3)]
    got = nearest(table(spark, queries), table(spark, base), "id", ["f0", "f1", "f2"], 4, 30).collect()
    want = brute(queries, base, 4)
    assert {r["key"]: [n["neighbor"] for n in r["near"]] for r in got} == {k: [b for b, _ in v] for k, v in want.items()}


def test_fewer_rows_than_neighbours(spark):
    rows = points(7, 3, 2)
    df = table(spark, rows)
    assert all(len(r["near"]) == 2 for r in nearest(df, df, "id", ["f0", "f1"], 5).collect())


def test_leaves_tile_the_space():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 3))
    leaves = Leaves.build(x, 16)
    assert len(leaves.low) == 16
    inside = ((x[:, None] >= leaves.low[None]) & (x[:, None] < leaves.high[None])).all(axis=2)
    assert (inside.sum(axis=1) == 1).all()
    assert (leaves.distance2(x)[np.arange(500), leaves.home(x)] == 0).all()


def test_equal_distances_go_to_the_earlier_row():
    row, col, _ = nearest_rows(np.array([[0.0]]), np.array([[1.0], [-1.0], [1.0], [5.0]]), 2)
    assert list(col) == [0, 1]


@pytest.fixture(scope="module")
def imbalanced(spark):
    """90 rows of class 0, 10 of class 1."""
    rng = np.random.default_rng(4)
    rows = [(f"r{i}", int(i >= 90), *[float(v) for v in rng.random(5) + (i >= 90) * 0.3]) for i in range(100)]
    return spark.createDataFrame(rows, "id string, label int, f0 double, f1 double, f2 double, f3 double, f4 double").cache()


FEATURES = [f"f{i}" for i in range(5)]


def sizes(df):
    return {r["label"]: r["count"] for r in df.groupBy("label").count().collect()}


def test_under_and_oversampling(imbalanced):
    assert sizes(sampling.undersample(imbalanced, "id", "label")) == {0: 10, 1: 10}
    over = sampling.oversample(imbalanced, "id", "label")
    assert sizes(over) == {0: 90, 1: 90}
    assert over.where("copy = 0").count() == 100


def test_null_labels_are_no_class(spark, imbalanced):
    with_null = imbalanced.withColumn("label", F.when(F.expr("cast(substring(id, 2) as int) % 33 <> 5"), F.col("label")))
    counts = sizes(with_null)
    missing, (small, large) = counts.pop(None), sorted(counts.values())
    assert missing >= 3
    under = sizes(sampling.undersample(with_null, "id", "label"))
    assert under == {None: missing, 0: small, 1: small}
    assert sizes(sampling.oversample(with_null, "id", "label")) == {None: missing, 0: large, 1: large}
    weights = {r.label: r.w for r in sampling.class_weights(with_null, "label", "w").select("label", "w").distinct().collect()}
    assert weights[None] is None and weights[0] == pytest.approx((small + large) / (2 * counts[0]))
    for make in (resample.smote, resample.adasyn):
        made = make(with_null, "id", "label", FEATURES)
        assert made.where("label is null").count() == missing and made.where("synthetic and label is null").count() == 0
        if make is resample.smote:
            assert sizes(made) == {None: missing, 0: large, 1: large}


def test_many_classes(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") < 6000, F.col("id") % 3000).otherwise(F.lit(1)).alias("label"))
    assert sampling.undersample(df, "id", "label").groupBy("label").count().where("count <> 2").count() == 0
    assert sampling.class_weights(df, "label").where("weight is null").count() == 0


@pytest.mark.parametrize("make", [resample.smote, resample.adasyn])
def test_synthetic_rows(imbalanced, make):
    out = make(imbalanced, "id", "label", FEATURES).toPandas()
    made = out[out["synthetic"]]
    assert len(out[~out["synthetic"]]) == 100
    assert set(made["label"]) == {1}
    if make is resample.smote:
        assert len(made) == 80
    else:
        assert abs(len(made) - 80) <= 5  # each row's share is rounded
    small = out[(out["label"] == 1) & ~out["synthetic"]]
    for f in FEATURES:  # interpolation stays inside the class
        assert made[f].between(small[f].min(), small[f].max()).all()


def test_synthetic_rows_repeat(imbalanced):
    a = resample.smote(imbalanced, "id", "label", FEATURES).toPandas().sort_values("id", ignore_index=True)
    b = resample.smote(imbalanced.repartition(7), "id", "label", FEATURES, leaf_rows=3).toPandas().sort_values("id", ignore_index=True)
    assert a.equals(b)


def test_adasyn_without_contact(spark):
    rows = [(f"a{i}", 0, float(i)) for i in range(20)] + [(f"b{i}", 1, 1000.0 + i) for i in range(8)]
    with pytest.raises(ValueError, match="smote"):
        resample.adasyn(spark.createDataFrame(rows, "id string, label int, x double"), "id", "label", ["x"])


def test_class_weights(imbalanced):
    got = {r["label"]: r["weight"] for r in sampling.class_weights(imbalanced, "label").select("label", "weight").distinct().collect()}
    assert got == {0: pytest.approx(100 / 180), 1: pytest.approx(5.0)}


def test_stratified_split_keeps_shares(imbalanced):
    train, test = sampling.train_test(sampling.split_stratified(imbalanced, "id", ["label"]))
    assert sizes(train) == {0: 72, 1: 8} and sizes(test) == {0: 18, 1: 2}


def test_folds(imbalanced):
    folds = sampling.folds_stratified(imbalanced, "id", ["label"], 5).groupBy("fold", "label").count().collect()
    assert {(r["fold"], r["label"]): r["count"] for r in folds} == {(f, y): n for f in range(5) for y, n in ((0, 18), (1, 2))}
    custom = sampling.folds_by(imbalanced, F.col("label"))
    assert {r["fold"] for r in custom.select("fold").distinct().collect()} == {0, 1}


def test_time_folds_take_the_rest_first(spark):
    df = spark.range(23).withColumnRenamed("id", "t")
    out = sampling.folds_time(df, ["t"], 5).groupBy("block").agg(F.count("*").alias("n"), F.min("t").alias("a")).orderBy("block").collect()
    assert [(r["block"], r["n"], r["a"]) for r in out] == [(0, 8, 0), (1, 3, 8), (2, 3, 11), (3, 3, 14), (4, 3, 17), (5, 3, 20)]


def test_sample_feed_may_repeat(spark):
    from stayline.sources.tables import sample_messages
    df = spark.range(100).select(F.col("id").cast("string").alias("customerID"))
    out = sample_messages(df, "customerID", 3.0, F.lit("2024-01-01T00:00:00"))
    assert out.count() > out.select("key").distinct().count()

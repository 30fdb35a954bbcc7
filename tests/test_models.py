import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators import ensembles, explain, models, scoring
from stayline.operators.clean import clean_subscribers
from stayline.operators.metrics import roc_auc
from stayline.operators.sampling import split_stratified, train_test
from stayline.operators.group_models import GroupMeanDeviation
from stayline.operators.stages import BalancedWeights, ColumnImputer, Cut, IqrClipper, SubscriberFeatures
from stayline.sources import models as store
from stayline.sources.fixtures import subscribers

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    df = clean_subscribers(subscribers(spark, SMALL)).cache()
    train, test = train_test(split_stratified(df, S.KEY, ["label"]))
    return df, train.cache(), test.cache()


def values(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_scores_are_probabilities_and_repeat(data):
    df, train, _ = data
    a = models.fit_scores(train, df, models.classifier("rf", numTrees=10, maxDepth=4))
    b = models.fit_scores(train, df, models.classifier("rf", numTrees=10, maxDepth=4))
    assert a.count() == df.count()
    assert a.where("score < 0 or score > 1 or (prediction = 1) != (score > 0.5)").count() == 0
    assert values(a) == values(b)
    assert roc_auc(a).first()["roc_auc"] > 0.6


def test_rows_with_nulls_are_scored(data, spark):
    df, train, _ = data
    broken = df.limit(3).withColumn("tenure", F.lit(None).cast("int")).withColumn("Contract", F.lit("Unseen"))
    assert models.fit_scores(train, broken, models.classifier("lr")).where("score is not null").count() == 3


@pytest.mark.parametrize("encoding,scaling", [("onehot", "minmax"), ("label", "standard"), ("label", None)])
def test_preparation_variants(data, encoding, scaling):
    _, train, _ = data
    out = models.preparation(encoding=encoding, scaling=scaling, clip_outliers=True).fit(train).transform(train)
    size = out.select("features").first()["features"].size
    assert size == 18 if encoding == "label" else size > 40
    assert out.count() == train.count()


def test_unknown_settings():
    with pytest.raises(ValueError):
        models.preparation(encoding="other")
    with pytest.raises(ValueError):
        models.preparation(scaling="other")


def test_saved_model_scores_the_same(spark, data, tmp_path):
    df, train, _ = data
    raw = subscribers(spark, SMALL)
    stages = [SubscriberFeatures(), *models.preparation(clip_outliers=True).getStages(), models.classifier("dt")]
    model = Pipeline(stages=stages).fit(train.drop("label").join(train.select(S.KEY, "label"), S.KEY))
    path = store.model_path(str(tmp_path), "dt", 1)
    assert not store.artifacts_present(spark, path)
    store.save_model(spark, model, path, "dt", 1, {"auc": 0.8}, S.NUMERIC_FEATURES, "2024-01-01T00:00:00")
    assert store.artifacts_present(spark, path)
    again = store.load_model(path)
    assert isinstance(again, PipelineModel)
    before, after = (scoring.predictions(m.transform(raw).withColumn("score", scoring.positive_probability())) for m in (model, again))
    assert values(before) == values(after)
    one = raw.where("customerID = '5'")  # one row goes the same way
    single = scoring.predictions(again.transform(one).withColumn("score", scoring.positive_probability()))
    assert values(single) == [v for v in values(before) if v[0] == "5"]
    meta = store.load_metadata(spark, path)
    assert meta["version"] == "1" and meta["metrics"] == {"auc": 0.8}


def test_stages_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, "x", 0), ("a", 2.0, None, 0), ("b", 90.0, "x", 1), ("c", None, "y", 0)],
                               "g string, v double, s string, label int").coalesce(1)
    stages = [ColumnImputer(inputCols=["v"], strategy="median"), ColumnImputer(inputCols=["s"], strategy="mode"),
              IqrClipper(inputCols=["v"]), GroupMeanDeviation(inputCol="v", groupCol="g", outputCol="dev"), BalancedWeights(),
              Cut(inputCol="v", outputCol="band", edges=[0.0, 2.0, float("inf")], labels=["low", "high"])]
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    out, again = model.transform(df), PipelineModel.load(str(tmp_path / "m")).transform(df)
    assert values(out.fillna(-1.0)) == values(again.fillna(-1.0))
    rows = out.collect()
    assert rows[1]["s"] == "x" and rows[3]["v"] == 2.0 and rows[3]["band"] == "low"
    assert [round(r["weight"], 4) for r in rows] == [0.6667, 0.6667, 2.0, 0.6667]
    unseen = model.transform(spark.createDataFrame([("new", 1.0, "x", 1)], df.schema))
    assert unseen.first()["dev"] is None


def test_bounds_come_from_training_only(spark):
    train = spark.createDataFrame([(float(i),) for i in range(9)], "v double")
    fitted = IqrClipper(inputCols=["v"]).fit(train)
    other = spark.createDataFrame([(1000.0,), (None,)], "v double").coalesce(1)
    assert [r[0] for r in fitted.transform(other).collect()] == [12.0, None]


def test_imputer_rejects_unknown_strategy(spark):
    with pytest.raises(ValueError):
        ColumnImputer(inputCols=["v"], strategy="guess").fit(spark.createDataFrame([(1.0,)], "v double"))


def test_cross_validation_picks_from_the_grid(data):
    _, train, _ = data
    prepared = models.prepare(train)
    tree = models.classifier("dt")
    grid = models.grid(tree, {"maxDepth": [1, 3]})
    best, table = models.cross_validate(prepared.train, tree, grid, folds=3)
    rows = table.collect()
    assert {r["params"] for r in rows} == {"maxDepth=1", "maxDepth=3"} and sum(r["best"] for r in rows) == 1
    assert best.depth <= 3
    assert len(models.random_grid(tree, {"maxDepth": [1, 2, 3], "minInstancesPerNode": [1, 2]}, 4)) == 4
    assert models.random_grid(tree, {"maxDepth": [1, 2, 3]}, 2) == models.random_grid(tree, {"maxDepth": [1, 2, 3]}, 2)
    prepared.release()


@pytest.mark.parametrize("build", [ensembles.voting, ensembles.blending,
                                   lambda t, e: ensembles.stacking(t, e, folds=2), lambda t, e: ensembles.voting(t, e, "hard")])
def test_ensembles(data, build):
    df, train, _ = data
    out = build(train, {"lr": models.classifier("lr"), "dt": models.classifier("dt")}).transform(df)
    assert out.columns == [S.KEY, "label", "score", "prediction"]
    assert out.count() == df.count() and out.where("score between 0 and 1").count() == df.count()
    assert roc_auc(out).first()["roc_auc"] > 0.6


def test_select_best(data):
    _, train, test = data
    model, table = models.train_select(train, test, {"lr": models.classifier("lr"), "dt": models.classifier("dt", maxDepth=1)})
    rows = {r["model"]: r for r in table.collect()}
    best = max(rows.values(), key=lambda r: r["roc_auc"])
    assert best["selected"] and sum(r["selected"] for r in rows.values()) == 1
    assert models.scores(model.transform(test)).count() == test.count()


def test_segments_keep_incomplete_rows(spark):
    rows = [(i, float(i // 25 * 20 + i % 5), float(i // 25 * 50 + i % 7)) for i in range(100)] + [(100, None, 5.0)]
    out = models.segments(spark.createDataFrame(rows, "id int, tenure double, MonthlyCharges double"), starts=3).toPandas()
    assert len(out) == 101 and out.columns.tolist() == ["id", "tenure", "MonthlyCharges", "segment"]
    assert out.loc[out["id"] == 100, "segment"].isna().all()
    means = out.dropna().groupby("segment")["tenure"].mean()
    assert len(means) == 4 and means.is_monotonic_increasing


def test_importance(data):
    _, train, test = data
    prepared = models.prepare(train)
    forest = models.classifier("rf", numTrees=10).fit(prepared.train)
    top = explain.top_features(train, forest, prepared.names, 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]
    assert "tenure" in [r["feature"] for r in top]
    model = PipelineModel([*prepared.model.stages, forest])
    found = {r["feature"]: r["importance"] for r in explain.permutation_importance(test, model, S.KEY, ["tenure", "gender"]).collect()}
    assert found["tenure"] > found["gender"]
    prepared.release()


def test_shuffling_keeps_the_values(data):
    df, _, _ = data
    out = explain.shuffle_column(df.select(S.KEY, "tenure"), S.KEY, "tenure")
    assert sorted(r[0] for r in out.select("tenure").collect()) == sorted(r[0] for r in df.select("tenure").collect())
    moved = out.join(df.select(S.KEY, F.col("tenure").alias("was")), S.KEY).where("tenure != was").count()
    assert moved > out.count() / 2


def test_contributions_add_up(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", 3.0, 30.0)], "id string, x double, y double")
    out = explain.linear_contributions(df, "id", {"x": 2.0, "y": -0.1})
    assert {(r["id"], r["feature"]): round(r["contribution"], 6) for r in out.collect()} == {
        ("a", "x"): -2.0, ("a", "y"): 1.0, ("b", "x"): 2.0, ("b", "y"): -1.0}
    top = explain.top_contributions(out, "id", 1).collect()
    assert {r["feature"] for r in top} == {"x"}


def test_fold_scores_of_a_fitted_model(spark):
    """Folds in time, by a rule and stratified, judged by the area under the curve."""
    from stayline.operators import metrics, sampling
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("customerID"), F.col("id").alias("t"), (F.col("id") % 10).cast("double").alias("x"),
        F.when(F.col("id") % 10 + F.col("id") % 3 > 5, 1.0).otherwise(0.0).alias("label"))
    fit = models.fitting(models.classifier("lr"), models.preparation(["x"], []))
    timed = models.fold_scores(sampling.folds_time(rows, ["t"], 3), fit, "block", expanding=True).collect()
    assert sorted(r.block for r in timed) == [1, 2, 3] and all(r.score > 0.9 for r in timed)
    dealt = models.fold_scores(sampling.folds_stratified(rows, "customerID", ["label"], 4), fit)
    gate = metrics.stability(dealt).first()
    assert gate.folds == 4 and gate.stable and gate.mean_score > 0.9


@pytest.fixture
def many_tasks(spark):
    """Shuffles of forty partitions, as tables at size have them."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark.sparkContext.defaultParallelism
    for k, v in kept.items():
        spark.conf.set(k, v)


def recorded(monkeypatch, kind):
    """The partitions of every table that ``kind`` is fitted on."""
    seen, fit = [], kind.fit
    monkeypatch.setattr(kind, "fit", lambda self, df, *a: (seen.append(df.rdd.getNumPartitions()), fit(self, df, *a))[1])
    return seen


def test_segments_run_a_task_per_core(spark, many_tasks, monkeypatch):
    seen = recorded(monkeypatch, models.KMeans)
    df = spark.range(400).select("id", (F.col("id") % 4 * 20).cast("double").alias("tenure"),
                                 (F.col("id") % 4 * 50 + F.col("id") % 3).cast("double").alias("MonthlyCharges"))
    out = models.segments(df.repartition(40, "id"), starts=2)
    assert len(seen) == 2 and max(seen) <= many_tasks
    assert out.where("segment = tenure / 20").count() == 400


def test_prepared_tables_have_a_task_per_core(spark, many_tasks, data):
    prepared = models.prepare(data[1].repartition(40, S.KEY))
    assert prepared.train.rdd.getNumPartitions() <= many_tasks
    assert prepared.train.count() == data[1].count()
    prepared.release()


def test_folds_have_a_task_per_core(spark, many_tasks, monkeypatch):
    rows = spark.range(400).select(F.col("id").cast("string").alias(S.KEY), (F.col("id") % 10).cast("double").alias("x"),
                                   F.when(F.col("id") % 10 > 5, 1.0).otherwise(0.0).alias("label"))
    train = models.VectorAssembler(inputCols=["x"], outputCol="features").transform(rows).repartition(40, S.KEY)
    seen, lr = recorded(monkeypatch, models.CrossValidator), models.classifier("lr", maxIter=5)
    _, table = models.cross_validate(train, lr, models.grid(lr, {"regParam": [0.0, 0.1]}))
    assert len(seen) == 1 and seen[0] <= many_tasks
    assert all(r["mean_auc"] > 0.99 for r in table.collect())


def test_stacked_folds_have_a_task_per_core(spark, many_tasks, data, monkeypatch):
    seen, fit = [], ensembles.fit_all
    monkeypatch.setattr(ensembles, "fit_all", lambda df, e: (seen.append(df.rdd.getNumPartitions()), fit(df, e))[1])
    out = ensembles.stacking(data[1], {"lr": models.classifier("lr", maxIter=5)}, folds=2).transform(data[0])
    assert len(seen) == 3 and max(seen) <= many_tasks
    assert out.count() == data[0].count()

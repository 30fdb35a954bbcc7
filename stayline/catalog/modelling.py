"""Queries that train models. Trained results have no SQL twin; tests hold them to invariants."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.catalog.registry import query, rounded
from stayline.operators import boosting, ensembles, explain, group_models, models, newton, trees
from stayline.operators.clean import clean_subscribers
from stayline.operators.sampling import folds_stratified, split_stratified, train_test
from stayline.operators.scoring import positive_probability
from stayline.plans.durable import work_path
from stayline.sources.fixtures import subscribers, table


def labelled(spark, sf):
    return clean_subscribers(subscribers(spark, sf))


def split(spark, sf):
    return train_test(split_stratified(labelled(spark, sf), S.KEY, ["label"]))


def _scores(spark, sf, name, **params):
    """Train on the training share, score every subscriber."""
    train, _ = split(spark, sf)
    return models.fit_scores(train, labelled(spark, sf), models.classifier(name, **params))


@query("lr_scores")
def lr_scores(spark, sf):
    return _scores(spark, sf, "lr")


@query("rf_scores")
def rf_scores(spark, sf):
    """Balanced class weights, as the forest is configured."""
    train, _ = split(spark, sf)
    return models.fit_scores(train, labelled(spark, sf), models.classifier("rf", weight="weight"),
                             models.preparation(balanced=True))


@query("gbt_scores")
def gbt_scores(spark, sf):
    return _scores(spark, sf, "gbt")


# --- fits whose result is determined, so that SQL knows it ---------------------------------------------------------

_CLEAN = """, c as (select *, case when Churn = 'Yes' then 1.0 else 0.0 end y from subscribers
  where try_cast(trim(TotalCharges) as double) is not null and Churn in ('Yes', 'No'))"""
_BOTH = ["Contract", "InternetService"]


@query("lr_score_equations", f"""{_CLEAN}
select 'Contract' as "column", Contract as value, round(avg(y), 3) as mean_score from c group by 2
union all select 'InternetService', InternetService, round(avg(y), 3) from c group by 2""", ("subscribers",))
def lr_score_equations(spark, sf):
    """Without penalty the mean score of the training rows of a category is the share of churners in it."""
    rows = labelled(spark, sf)
    scored = models.fit_scores(rows, rows, models.classifier("lr", regParam=0.0, maxIter=300, tol=1e-12),
                               models.preparation([], _BOTH, scaling=None)).join(rows.select(S.KEY, *_BOTH), S.KEY)
    return scored.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in _BOTH]))
                         .alias("e"), "score").groupBy("e").agg(F.round(F.avg("score"), 3).alias("mean_score")).select("e.*", "mean_score")


def _leaf_shares(spark, sf, estimator):
    """A tree over one two-valued column scores every row with the share of churners of its value. The two values have
    different majorities: leaves that predict the same class would be merged."""
    rows = labelled(spark, sf).withColumn("band", F.when(F.col("tenure") < 36, "short").otherwise("long"))
    scored = models.fit_scores(rows, rows, estimator, models.preparation([], ["band"], scaling=None))
    return rounded(scored.join(rows.select(S.KEY, "band"), S.KEY).select("band", "score").distinct())


_SHARES = f"{_CLEAN}\nselect case when tenure < 36 then 'short' else 'long' end as band, round(avg(y), 6) as score from c group by 1"


@query("dt_leaf_shares", _SHARES, ("subscribers",))
def dt_leaf_shares(spark, sf):
    return _leaf_shares(spark, sf, models.classifier("dt"))


@query("rf_leaf_shares", _SHARES, ("subscribers",))
def rf_leaf_shares(spark, sf):
    """One tree on all rows and features."""
    return _leaf_shares(spark, sf, models.classifier("rf", numTrees=1, featureSubsetStrategy="all", bootstrap=False))


# --- second-order boosting -----------------------------------------------------------------------------------------

_FLAGS = {"is_short": "tenure < 36", "is_monthly": "Contract = 'Month-to-month'", "is_senior": "SeniorCitizen = 1"}


@query("boost_stump", f"""{_CLEAN},
b as (select customerID, y, case when tenure < 36 then 1 else 0 end as is_short, case when Contract = 'Month-to-month' then 1 else 0 end as is_monthly,
  case when SeniorCitizen = 1 then 1 else 0 end as is_senior from c),
f as (select customerID, y, 1 as f, is_short as v from b union all select customerID, y, 2, is_monthly from b union all select customerID, y, 3, is_senior from b),
s as (select f, v, sum(0.5::double - y) as g, count(*) / 4.0::double as h from f group by 1, 2),
p as (select f, round(sum(g * g / (h + 1)), 9) as gain from s group by 1 having count(*) = 2),
best as (select f from p order by gain desc, f limit 1)
select customerID, round(1 / (1 + exp(0.3 * g / (h + 1))), 6) as score from f join best using (f) join s using (f, v)""", ("subscribers",))
def boost_stump(spark, sf):
    """One tree with one split, on the flag that SQL finds the best by gain too."""
    rows = labelled(spark, sf).withColumns({c: F.expr(e).cast("int") for c, e in _FLAGS.items()})
    model = boosting.fit_boosted(rows, list(_FLAGS), rounds=1, depth=1, rate=0.3)
    return rounded(model.score(rows).select(S.KEY, "score"))


@query("boosted_scores")
def boosted_scores(spark, sf):
    """Numeric columns and ordered target statistics of the categories, boosted; later rows get the fitted statistics."""
    train, _ = split(spark, sf)
    encoder = group_models.TargetEncoder(inputCols=S.CATEGORICAL_FEATURES)
    names = [*S.NUMERIC_FEATURES, *[f"{c}_target" for c in S.CATEGORICAL_FEATURES]]
    model = boosting.fit_boosted(encoder.encode_training(train, S.KEY), names, rounds=20, depth=4, rate=0.3)
    scored = model.score(encoder.fit(train).transform(labelled(spark, sf)))
    return scored.select(S.KEY, "label", "score", (F.col("score") > 0.5).cast("int").alias("prediction"))


# --- fitted values per group ---------------------------------------------------------------------------------------

_ORDERED = "partition by {} order by md5(customerID || ':42') rows between unbounded preceding and 1 preceding"


@query("target_encode", f"""{_CLEAN}, m as (select avg(y) as p from c)
select customerID, round((coalesce(sum(y) over a, 0) + p) / (count(*) over a + 1), 6) as Contract_target,
  round((coalesce(sum(y) over b, 0) + p) / (count(*) over b + 1), 6) as PaymentMethod_target from c, m
window a as ({_ORDERED.format('Contract')}), b as ({_ORDERED.format('PaymentMethod')})""", ("subscribers",))
def target_encode(spark, sf):
    """Categories of training rows by the labels of the rows before them."""
    encoder = group_models.TargetEncoder(inputCols=["Contract", "PaymentMethod"])
    return rounded(encoder.encode_training(labelled(spark, sf), S.KEY).select(S.KEY, "Contract_target", "PaymentMethod_target"))


@query("target_encode_later", f"""{_CLEAN}, t as (select * from c where cast(customerID as bigint) % 3 <> 0), m as (select avg(y) as p from t),
g as (select PaymentMethod, sum(y) as s, count(*) as n from t group by 1)
select customerID, round((coalesce(s, 0) + p * 5) / (coalesce(n, 0) + 5), 6) as PaymentMethod_target
from c left join g on c.PaymentMethod is not distinct from g.PaymentMethod, m where cast(customerID as bigint) % 3 = 0""", ("subscribers",))
def target_encode_later(spark, sf):
    """Rows that come later, by all training rows of their category; the encoder is saved and loaded in between."""
    rows, later = labelled(spark, sf), F.col(S.KEY).cast("long") % 3 == 0
    path = work_path(spark, "encoder")
    group_models.TargetEncoder(inputCols=["PaymentMethod"], weight=5.0).fit(rows.where(~later)).save(path)
    return rounded(group_models.TargetEncoderModel.load(path).transform(rows.where(later)).select(S.KEY, "PaymentMethod_target"))


@query("group_deviation", """
select o_orderkey, round(o_totalprice - avg(o_totalprice) over (partition by o_custkey), 6) as vs_customer from orders""")
def group_deviation(spark, sf):
    """Order totals against the mean of their customer, a group per customer; fitted, saved, loaded and applied."""
    orders, path = table(spark, sf, "orders"), work_path(spark, "deviation")
    stage = group_models.GroupMeanDeviation(inputCol="o_totalprice", groupCol="o_custkey", outputCol="vs_customer")
    stage.fit(orders).save(path)
    return rounded(group_models.GroupMeanDeviationModel.load(path).transform(orders).select("o_orderkey", "vs_customer"))


# --- explanations of single rows -----------------------------------------------------------------------------------

def _explained(rows, estimator, stages=None):
    """Fitted tree model, its feature names, and the rows as the model scores them."""
    prepared = models.prepare(rows, stages)
    model = estimator.fit(prepared.train)
    prepared.release()
    return model, prepared.names, model.transform(prepared.model.transform(rows))


@query("tree_contributions", f"""{_CLEAN}
select customerID, 'band' as feature, round(avg(y) over (partition by tenure < 36) - avg(y) over (), 6) as contribution from c""",
       ("subscribers",))
def tree_contributions(spark, sf):
    """In a tree with one split a row is moved from the mean of all rows to the mean of its side."""
    rows = labelled(spark, sf).withColumn("band", F.when(F.col("tenure") < 36, "short").otherwise("long"))
    model, names, scored = _explained(rows, models.classifier("dt"), models.preparation([], ["band"], scaling=None))
    parts = trees.by_column(trees.tree_contributions(scored, model, [S.KEY], names), [S.KEY], ["band"])
    return rounded(parts.select(S.KEY, "feature", "contribution"))


@query("forest_contributions", f"""{_CLEAN}
select customerID, 0.0::double as gap from c""", ("subscribers",))
def forest_contributions(spark, sf):
    """What is left of a forest's score when its expectation and the contributions of all features are taken off."""
    model, _, scored = _explained(labelled(spark, sf), models.classifier("rf", numTrees=20, maxDepth=5))
    rows = trees.explain_rows(scored.withColumn("score", positive_probability()), model, [S.KEY, "score"])
    total = F.aggregate("contributions", F.col("base"), lambda a, b: a + b)
    return rows.select(S.KEY, F.abs(F.round(F.col("score") - total, 6)).alias("gap"))


def _bases():
    return {"lr": models.classifier("lr"), "dt": models.classifier("dt"), "rf": models.classifier("rf", numTrees=20, maxDepth=5)}


@query("stack_scores")
def stack_scores(spark, sf):
    train, _ = split(spark, sf)
    return ensembles.stacking(train, _bases(), folds=3).transform(labelled(spark, sf))


@query("blend_scores")
def blend_scores(spark, sf):
    train, _ = split(spark, sf)
    return ensembles.blending(train, _bases()).transform(labelled(spark, sf))


_CONTRACTS = ["Month-to-month", "One year", "Two year"]


@query("fold_score_equations", f"""{_CLEAN}, f as (select *, cast(tenure as int) % 3 as fold from c),
k as (select distinct fold, Contract from f where fold is not null)
select k.fold, k.Contract, round(avg(y), 6) as score
from k join f on k.Contract is not distinct from f.Contract and k.fold <> f.fold group by 1, 2""", ("subscribers",))
def fold_score_equations(spark, sf):
    """Without penalty the score of a category is the share of churners among the rows of the other folds."""
    rows = labelled(spark, sf).select("Contract", "label", (F.col("tenure").cast("int") % 3).alias("fold"), F.array(
        *[F.coalesce((F.col("Contract") == c).cast("double"), F.lit(0.0)) for c in _CONTRACTS]).alias("features"))
    scored = newton.held_out_scores(rows, newton.fit_folds(rows))
    return rounded(scored.select("fold", "Contract", F.col("scores")[0].alias("score")).where("fold is not null").distinct())


@query("penalty_grid")
def penalty_grid(spark, sf):
    """Penalties of a logistic model over five stratified folds, all fitted together."""
    prepared = models.prepare(labelled(spark, sf))
    folds = folds_stratified(prepared.train, S.KEY, ["label"], 5)
    found = newton.compare_penalties(folds, [0.0001, 0.001, 0.01, 0.1, 1.0])
    prepared.release()
    return found


@query("grid_search")
def grid_search(spark, sf):
    """Logistic regression over inverse strength and penalty, 5 folds."""
    train, _ = split(spark, sf)
    prepared = models.prepare(train)
    lr = models.classifier("lr")
    rows = prepared.train.count()
    candidates = models.grid(lr, {"regParam": [models.regularization(c, rows) for c in (0.1, 1, 10)], "elasticNetParam": [1.0, 0.0]})
    _, table = models.cross_validate(prepared.train, lr, candidates, folds=5)
    prepared.release()
    return table


@query("random_search")
def random_search(spark, sf):
    train, _ = split(spark, sf)
    prepared = models.prepare(train)
    tree = models.classifier("dt")
    lists = {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4], "maxBins": [32, 64]}
    _, table = models.cross_validate(prepared.train, tree, models.random_grid(tree, lists, 8), folds=3)
    prepared.release()
    return table


@query("feature_sets")
def feature_sets(spark, sf):
    train, test = split(spark, sf)
    return models.compare_feature_sets(train, test, {
        "numeric_only": (S.NUMERIC_FEATURES, []), "all_features": (S.NUMERIC_FEATURES, S.CATEGORICAL_FEATURES)},
        models.classifier("rf"))


@query("segments")
def segments(spark, sf):
    return models.segments(subscribers(spark, sf).select(S.KEY, "tenure", "MonthlyCharges", "Churn"))


@query("top_features")
def top_features(spark, sf):
    train, _ = split(spark, sf)
    prepared = models.prepare(train)
    forest = models.classifier("rf").fit(prepared.train)
    prepared.release()
    return explain.top_features(train, forest, prepared.names, 10)


@query("permutation_importance")
def permutation_importance(spark, sf):
    train, test = split(spark, sf)
    prepared = models.prepare(train)
    model = PipelineModel([*prepared.model.stages, models.classifier("lr").fit(prepared.train)])
    prepared.release()
    return explain.permutation_importance(test, model, S.KEY, [*S.NUMERIC_FEATURES, "Contract"])


@query("train_select")
def train_select(spark, sf):
    train, test = split(spark, sf)
    _, table = models.train_select(train, test, {
        "logistic regression": models.classifier("lr"), "random forest": models.classifier("rf"),
        "gradient boosting": models.classifier("gbt")})
    return table

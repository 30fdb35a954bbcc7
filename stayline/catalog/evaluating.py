"""Queries over evaluation, scoring, business figures and messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.catalog.cleaning import edge_time
from stayline.catalog.registry import SQL, query, rounded
from stayline.functions.scalars import iso_timestamp
from stayline.operators import business, metrics, sampling, scoring
from stayline.operators.explain import linear_contributions
from stayline.operators.models import fold_scores
from stayline.plans.ordered import exact_quantiles
from stayline.plans.small import join_groups, settle
from stayline.sources.fixtures import model_scores, scored, subscribers, table
from stayline.streaming.messages import drop_replays, latency

SUB = ("subscribers",)
SCO = ("subscribers", "scored")
MOD = ("subscribers", "model_scores")
MODELS = {"a": "score_a", "b": "score_b", "c": "score_c"}

_CELLS = """select count(*) filter (label = 0 and prediction = 0) as tn, count(*) filter (label = 0 and prediction = 1) as fp,
  count(*) filter (label = 1 and prediction = 0) as fn, count(*) filter (label = 1 and prediction = 1) as tp from scored"""


@query("confusion_matrix", _CELLS, SCO)
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf))


@query("binary_metrics", f""", c as ({_CELLS})
select round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1 from c""", SCO)
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(scored(spark, sf)))


_PER_CLASS = f"""c as ({_CELLS}), k as (
  select 0 as class, tn as hit, tn + fp as support, tn + fn as predicted, tp as other_hit, tp + fn as others from c
  union all select 1, tp, tp + fn, tp + fp, tn, tn + fp from c),
m as (select class, coalesce(hit / nullif(predicted, 0), 0) p, coalesce(hit / nullif(support, 0), 0) r,
  coalesce(other_hit / nullif(others, 0), 0) s, coalesce(2 * hit / nullif(predicted + support, 0), 0) f, support from k)"""


@query("class_report", f""", {_PER_CLASS}
select cast(class as varchar) as class, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, support from m
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(support) as bigint) from m
union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), cast(sum(support) as bigint) from m""", SCO)
def class_report(spark, sf):
    return rounded(metrics.class_report(scored(spark, sf)))


@query("imbalance_report", f""", {_PER_CLASS},
g as (select *, sqrt(r * s) geo, (1 + 0.1 * (r - s)) * r * s iba from m)
select cast(class as varchar) as class, round(p, 6) as precision, round(r, 6) as recall, round(s, 6) as specificity,
  round(f, 6) as f1, round(geo, 6) as geo, round(iba, 6) as iba, support from g
union all select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(s * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
  round(sum(geo * support) / sum(support), 6), round(sum(iba * support) / sum(support), 6), cast(sum(support) as bigint) from g""", SCO)
def imbalance_report(spark, sf):
    return rounded(metrics.imbalance_report(scored(spark, sf)))


_POINTS = """d as (select score, sum(label) pos, count(*) - sum(label) neg from scored group by 1),
p as (select score, pos, neg, sum(pos) over w tp, sum(neg) over w fp, sum(pos) over () p, sum(neg) over () n
  from d window w as (order by score desc rows unbounded preceding))"""


@query("roc_auc", f", {_POINTS} select round(sum(pos * (n - fp + neg / 2.0)) / max(p * n), 6) as roc_auc from p", SCO)
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scored(spark, sf)))


@query("roc_curve", f""", {_POINTS}
select score as threshold, round(fp / n, 6) as fpr, round(tp / p, 6) as tpr from p union all select null, 0.0, 0.0""", SCO)
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(scored(spark, sf)))


@query("pr_curve", f""", {_POINTS}
select score as threshold, round(tp / (tp + fp), 6) as precision, round(tp / p, 6) as recall from p
union all select null, 1.0, 0.0""", SCO)
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(scored(spark, sf)))


@query("pr_auc", f""", {_POINTS}, c as (select score, tp / (tp + fp) pr, tp / p r from p)
select round(sum((r - r0) * (pr + pr0) / 2), 6) as pr_auc from (
  select *, lag(r, 1, 0.0) over (order by score desc) r0, lag(pr, 1, 1.0) over (order by score desc) pr0 from c)""", SCO)
def pr_auc(spark, sf):
    return rounded(metrics.pr_auc(scored(spark, sf)))


_LONG = """l as (select 'a' as model, label, score_a s from model_scores union all select 'b', label, score_b from model_scores
  union all select 'c', label, score_c from model_scores),
cm as (select model, count(*) filter (label = 0 and s < 0.5) tn, count(*) filter (label = 0 and s >= 0.5) fp,
  count(*) filter (label = 1 and s < 0.5) fn, count(*) filter (label = 1 and s >= 0.5) tp from l group by 1),
d as (select model, s, sum(label) pos, count(*) - sum(label) neg from l group by 1, 2),
p as (select *, sum(pos) over w tp, sum(neg) over w fp, sum(pos) over (partition by model) p, sum(neg) over (partition by model) n
  from d window w as (partition by model order by s desc rows unbounded preceding)),
c as (select *, tp / (tp + fp) pr, tp / p r from p),
a as (select model, sum(pos * (n - fp + neg / 2.0)) / max(p * n) roc, sum((r - r0) * (pr + pr0) / 2) area from (
  select *, lag(r, 1, 0.0) over (partition by model order by s desc) r0, lag(pr, 1, 1.0) over (partition by model order by s desc) pr0 from c) group by 1),
res as (select model, round((tp + tn) / (tp + tn + fp + fn), 6) as accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) as precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) as recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) as f1,
  round(roc, 6) as roc_auc, round(area, 6) as pr_auc from cm join a using (model))"""


def compared(spark, sf):
    return rounded(metrics.compare_models(metrics.long_scores(model_scores(spark, sf), MODELS, [S.KEY, "label"])))


@query("compare_models", f", {_LONG} select * from res", MOD)
def compare_models(spark, sf):
    return compared(spark, sf)


@query("best_model", f", {_LONG} select * from res order by roc_auc desc, model limit 1", MOD)
def best_model(spark, sf):
    return metrics.best_by(compared(spark, sf), "roc_auc", "model")


@query("vote_soft", """
select customerID, label, round((score_a + score_b + score_c) / 3, 6) as score from model_scores""", MOD)
def vote_soft(spark, sf):
    return rounded(scoring.vote_soft(model_scores(spark, sf), list(MODELS.values())).select(S.KEY, "label", "score"))


@query("vote_hard", """
select customerID, label, case when (score_a >= 0.5)::int + (score_b >= 0.5)::int + (score_c >= 0.5)::int >= 2 then 1 else 0 end
  as prediction from model_scores""", MOD)
def vote_hard(spark, sf):
    return scoring.vote_hard(model_scores(spark, sf), list(MODELS.values())).select(S.KEY, "label", "prediction")


@query("cv_stability", """, f as (select label, prediction,
  (row_number() over (partition by label order by md5(concat(customerID, ':42')), customerID) - 1) % 10 as fold from scored),
s as (select fold, avg(case when label = prediction then 1.0 else 0.0 end) score from f group by 1)
select count(*) as folds, round(avg(score), 6) as mean_score, round(stddev_pop(score), 6) as std_score,
  stddev_pop(score) < 0.05 as stable from s""", SCO)
def cv_stability(spark, sf):
    rows = sampling.folds_stratified(scored(spark, sf), S.KEY, ["label"], 10)
    folds = rows.groupBy("fold").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("score"))
    return rounded(metrics.stability(folds))


def given(_train):
    """Stands in for a fitted model: the rows bring their scores."""
    return lambda rows: rows


@query("cv_time", """, r as (select *, row_number() over (order by customerID) - 1 i, count(*) over () n from scored),
b as (select *, case when i < n - 5 * (n // 6) then 0 else (i - (n - 5 * (n // 6))) // (n // 6) + 1 end block from r)
select cast(block as int) as block, round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as score from b where block > 0 group by 1""", SCO)
def cv_time(spark, sf):
    blocks = sampling.folds_time(scored(spark, sf), [S.KEY], 5)
    return rounded(fold_scores(blocks, given, "block", expanding=True, metric="accuracy"))


@query("cv_custom", """
select cast(length(Contract) % 3 as int) as fold, round(avg(case when label = prediction then 1.0 else 0.0 end), 6) as score
from scored group by 1""", SCO)
def cv_custom(spark, sf):
    folds = sampling.folds_by(scored(spark, sf), F.length("Contract") % 3)
    return rounded(fold_scores(folds, given, metric="accuracy"))


@query("cv_model_stability", SQL["cv_stability"])
def cv_model_stability(spark, sf):
    """The stability gate over the fold scores of a model."""
    rows = sampling.folds_stratified(scored(spark, sf), S.KEY, ["label"], 10)
    return rounded(metrics.stability(fold_scores(rows, given, metric="accuracy")))


# --- scoring -------------------------------------------------------------------------------------------------------

@query("score_batch", """
select customerID, score as churn_probability, case when score >= 0.5 then 'Yes' else 'No' end as prediction,
  case when score >= 0.5 then 'Churn' else 'No Churn' end as prediction_label,
  case when score < 0.3 then 'Low' when score < 0.7 then 'Medium' else 'High' end as risk_level,
  round(greatest(score, 1 - score), 6) as confidence_score from scored""", SCO)
def score_batch(spark, sf):
    return rounded(scoring.predictions(scored(spark, sf)))


@query("confidence", "select customerID, round(greatest(score, 1 - score), 6) as confidence_score from scored", SCO)
def confidence(spark, sf):
    return rounded(scored(spark, sf).select(S.KEY, scoring.confidence("score").alias("confidence_score")))


@query("prediction_envelope", """
select customerID as key, cast(to_json({'customerID': customerID, 'churn_probability': score,
  'prediction': case when score >= 0.5 then 'Yes' else 'No' end, 'confidence_score': round(greatest(score, 1 - score), 6),
  'event_ts': '2023-12-31T23:59:59.500000', 'processed_ts': '2024-01-01T00:00:00.000000'}) as varchar) as value from scored""", SCO)
def prediction_envelope(spark, sf):
    rows = rounded(scoring.predictions(scored(spark, sf)))
    return scoring.envelope(rows, F.lit("2023-12-31T23:59:59.500000"), edge_time())


# Fixed scorecard used for the linear explanation
CARD = scoring.Scorecard(2.2, {"tenure": -0.045, "MonthlyCharges": 0.004})


@query("linear_contributions", """
select customerID, 'tenure' as feature, round(-0.045 * (tenure - (select avg(tenure) from subscribers)), 6) as contribution from subscribers
union all select customerID, 'MonthlyCharges', round(0.004 * (MonthlyCharges - (select avg(MonthlyCharges) from subscribers)), 6)
from subscribers""", SUB)
def linear_contributions_query(spark, sf):
    return rounded(linear_contributions(subscribers(spark, sf), S.KEY, CARD.coefficients))


# --- business --------------------------------------------------------------------------------------------------------

@query("clv", "select customerID, round(MonthlyCharges * 24 - 300, 6) as clv from subscribers", SUB)
def clv(spark, sf):
    return rounded(subscribers(spark, sf).select(S.KEY, business.lifetime_value("MonthlyCharges").alias("clv")))


@query("retention_roi", """, s as (select Contract, count(*) filter (Churn = 'Yes') as churners, count(*) filter (Churn = 'Yes' and tenure >= 12) as saved,
  50.0::double * count(*) filter (Churn = 'Yes' and Contract <> 'Two year') as cost from subscribers group by 1)
select Contract, churners, round(churners * 1380.0::double, 6) as churn_cost, saved, cost,
  case when cost = 0 then 'infinite' else cast(round((saved * 1380.0 - cost) / cost * 100) as bigint)::varchar end as roi_pct from s""", SUB)
def retention_roi(spark, sf):
    lost = F.col("Churn") == "Yes"
    value = business.default_value()
    sums = subscribers(spark, sf).groupBy("Contract").agg(
        F.count_if(lost).alias("churners"), F.count_if(lost & (F.col("tenure") >= 12)).alias("saved"),
        (F.count_if(lost & (F.col("Contract") != "Two year")) * S.CONTACT_COST).alias("cost"))
    gain = business.roi(F.col("saved") * value, F.col("cost"))
    return rounded(sums.select(
        "Contract", "churners", business.churn_cost("churners", value).alias("churn_cost"), "saved", "cost",
        F.when(gain == float("inf"), "infinite").otherwise(F.round(gain * 100).try_cast("long").cast("string")).alias("roi_pct")))


_CAMPAIGN = """k as (select count(*) filter (label = 1) as churners, count(*) filter (prediction = 1) as targeted,
  count(*) filter (label = 1 and prediction = 1) as hits from scored),
m as (select churners, targeted, hits * 0.5::double as saved, targeted * 50.0::double as cost, hits * 0.5::double * 1380.0 as revenue_saved from k)"""


@query("campaign", f""", {_CAMPAIGN}
select churners, targeted, saved, cost, revenue_saved, round((revenue_saved - cost) / cost, 6) as roi from m""", SCO)
def campaign(spark, sf):
    return rounded(business.campaign(scored(spark, sf)))


@query("impact_report", f""", {_CAMPAIGN}
select 1380.0::double as clv, churners, churners * 1380.0::double as unchecked_cost, targeted, saved, cost, revenue_saved,
  round((revenue_saved - cost) / cost, 6) as roi, revenue_saved - cost as net_benefit from m""", SCO)
def impact_report(spark, sf):
    return rounded(business.impact_report(scored(spark, sf)))


@query("revenue_at_risk", """
select count(*) as total_customers, cast(sum(label) as bigint) as actual_churners, cast(sum(prediction) as bigint) as predicted_churners,
  cast(sum(label * prediction) as bigint) as correctly_identified,
  concat('$', format('{:,.2f}', sum(MonthlyCharges) filter (label = 1))) as total_revenue_at_risk,
  concat('$', format('{:,.2f}', sum(MonthlyCharges) filter (label = 1 and prediction = 1))) as potential_revenue_saved from scored""", SCO)
def revenue_at_risk(spark, sf):
    rows = scored(spark, sf)
    return business.revenue_at_risk(rows.select(S.KEY, "label", "MonthlyCharges"), rows.select(S.KEY, "prediction"))


# --- message times ---------------------------------------------------------------------------------------------------

@query("latency_stats", """
with t as (select event_type, epoch_us(ts) us, 1000 * (event_id % 977) + 250000 as lag_us from events)
select event_type, count(*) as messages, round(avg(lag_us / 1e6), 6) as mean_s, round(quantile_cont(lag_us / 1e6, 0.5), 6) as p50_s,
  round(quantile_cont(lag_us / 1e6, 0.95), 6) as p95_s, round(max(lag_us / 1e6), 6) as max_s from t group by 1""")
def latency_stats(spark, sf):
    events = table(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = events.withColumn("processed_ts", F.timestamp_micros(micros + 250000 + 1000 * (F.col("event_id") % 977))).select(
        "event_type", latency(events, "ts", "processed_ts").alias("seconds"))
    basic = rows.groupBy("event_type").agg(F.count("*").alias("messages"), F.avg("seconds").alias("mean_s"), F.max("seconds").alias("max_s"))
    tails = exact_quantiles(rows, ["seconds"], [0.5, 0.95], ["event_type"]).select(
        "event_type", F.col("q")[0].alias("p50_s"), F.col("q")[1].alias("p95_s"))
    return rounded(join_groups(basic, settle(tails), ["event_type"], "left"))


@query("dedup_events", """
select distinct cast(user_id as varchar) as "customerID", strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%S.%f') as event_ts from events""")
def dedup_events(spark, sf):
    hourly = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("customerID"), iso_timestamp(F.date_trunc("hour", "ts")).alias("event_ts"))
    return drop_replays(hourly, ["customerID", "event_ts"])

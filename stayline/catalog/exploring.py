"""Queries over aggregates, exploration, splits and balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayline import schema as S
from stayline.catalog.registry import query, rounded
from stayline.functions.binning import risk_level, tenure_bin
from stayline.operators import clean, explore, runs, sampling, sketches, wide
from stayline.operators.features import prepare_table
from stayline.operators.metrics import long_scores
from stayline.plans.small import join_groups, settle
from stayline.sources.fixtures import messages, model_scores, scored, subscribers, table
from stayline.streaming.messages import batch_summary, window_counts

SUB = ("subscribers",)
SCO = ("subscribers", "scored")
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_TOTAL = "try_cast(trim(TotalCharges) as double)"


@query("churn_rate_by_group", f"""
select Contract, tenure_category, count(*) as subscribers, cast(sum(y) as bigint) as churners, round(avg(y) * 100, 6) as churn_rate
from (select Contract, case when Churn = 'Yes' then 1 else 0 end y,
  case when tenure between 1 and 12 then 'Short-term' when tenure between 13 and 24 then 'Mid-term'
    when tenure between 25 and 48 then 'Long-term' when tenure between 49 and 60 then 'Very-long-term'
    when tenure > 60 then 'Loyal' end as tenure_category from subscribers where {_TOTAL} is not null)
group by all""", SUB)
def churn_rate_by_group(spark, sf):
    """Flagship: churn by contract and tenure band on cleaned subscribers."""
    return rounded(explore.churn_rate_by_group(prepare_table(subscribers(spark, sf)), ["Contract", "tenure_category"]))


@query("value_counts", "select o_orderpriority as value, count(*) as n from orders where o_orderpriority is not null group by 1")
def value_counts(spark, sf):
    return explore.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@query("value_shares", """
select PaymentMethod as value, count(*) as n, round(count(*) / (select count(PaymentMethod) from subscribers), 6) as share
from subscribers where PaymentMethod is not null group by 1""", SUB)
def value_shares(spark, sf):
    return rounded(explore.value_shares(subscribers(spark, sf), "PaymentMethod"))


_DESC = " union all ".join(f"""select '{c}' as "column", count({c}) as count, round(avg({c}), 6) as mean,
  round(stddev_samp({c}), 6) as std, min({c})::double as min, round(quantile_cont({c}::double, 0.25), 6) as q25,
  round(quantile_cont({c}::double, 0.5), 6) as q50, round(quantile_cont({c}::double, 0.75), 6) as q75, max({c})::double as max
  from lineitem""" for c in LINE_NUMBERS)


@query("describe_numeric", _DESC)
def describe_numeric(spark, sf):
    return rounded(explore.describe_numeric(table(spark, sf, "lineitem").select(*LINE_NUMBERS)))


_ALL_NUM = ["SeniorCitizen", "tenure", "MonthlyCharges"]
_ALL_TXT = [f.name for f in S.subscriber_schema().fields if f.dataType.simpleString() == "string"]


@query("describe_all", ", t as (" + " union all ".join(f"select '{c}' c, {c} v from subscribers where {c} is not null" for c in _ALL_TXT) + """),
g as (select c, v, count(*) n from t group by all), u as (
select c as "column", cast(sum(n) as bigint) as count, count(*) as "unique",
  first(v order by n desc, v) as top, max(n) as freq from g group by 1)
select "column", count, "unique", top, freq, null::double mean, null::double std, null::double min, null::double q25,
  null::double q50, null::double q75, null::double max from u union all """ + " union all ".join(
    f"""select '{c}', count({c}), null, null, null, round(avg({c}), 6), round(stddev_samp({c}), 6), min({c})::double,
  round(quantile_cont({c}::double, 0.25), 6), round(quantile_cont({c}::double, 0.5), 6),
  round(quantile_cont({c}::double, 0.75), 6), max({c})::double from subscribers""" for c in _ALL_NUM), SUB)
def describe_all(spark, sf):
    return rounded(explore.describe_all(subscribers(spark, sf)))


_FIELDS = S.subscriber_schema().fields


@query("null_counts", " union all ".join(f"""{", t as (select * replace (" + _TOTAL + " as TotalCharges) from subscribers) " if i == 0 else ""}select '{f.name}' as "column",
  count(*) - count({f.name}) as nulls, round((count(*) - count({f.name})) * 100.0 / count(*), 6) as null_pct from t""" for i, f in enumerate(_FIELDS)), SUB)
def null_counts(spark, sf):
    return rounded(explore.null_counts(clean.coerce_numeric(subscribers(spark, sf), ["TotalCharges"])))


@query("duplicate_rows", """
select cast(coalesce(sum(n - 1), 0) as bigint) as duplicates from (select count(*) n from documents group by text, lang)""")
def duplicate_rows(spark, sf):
    return explore.duplicate_rows(table(spark, sf, "documents").select("text", "lang"))


def _listing(c: str, k: int) -> str:
    return (f"(select string_agg(v, ',' order by v) from (select distinct cast({c} as varchar) v from subscribers "
            f"where {c} is not null order by v limit {k}))")


@query("column_report", " union all ".join(f"""select '{f.name}' as "column", '{f.dataType.simpleString()}' as dtype,
  (select count(*) - count({f.name}) from subscribers) as nulls, (select count(distinct {f.name}) from subscribers) as n_unique,
  case when (select count(distinct {f.name}) from subscribers) < 10 then {_listing(f.name, 10)} end as distinct_values""" for f in _FIELDS), SUB)
def column_report(spark, sf):
    return explore.column_report(subscribers(spark, sf))


_PROFILED = [f for f in _FIELDS if f.dataType.simpleString() != "double"]


@query("profile", " union all ".join(f"""select '{f.name}' as "column", '{f.dataType.simpleString()}' as dtype,
  (select count({f.name}) from subscribers) as non_null,
  round((select (count(*) - count({f.name})) * 100.0 / count(*) from subscribers), 6) as null_pct,
  (select count(distinct {f.name}) from subscribers) as n_unique, {_listing(f.name, 3)} as samples""" for f in _PROFILED), SUB)
def profile(spark, sf):
    return rounded(explore.profile(subscribers(spark, sf).select(*[f.name for f in _PROFILED])))


_SKETCHED = ["user_id", "event_type", "value", "props"]


@query("distinct_sketches", " union all ".join(f"""select '{c}' as "column", count(*) as rows, count({c}) as non_null,
  count(distinct date_trunc('day', ts)) as days, true as within from events""" for c in _SKETCHED))
def distinct_sketches(spark, sf):
    """Sketches a day, united; whether the number of distinct values is within four standard errors of the exact one."""
    events = table(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts"))
    daily = sketches.distinct_sketches(events, _SKETCHED, ["day"])
    united = join_groups(sketches.distinct_estimates(daily), settle(daily.groupBy("column").agg(F.count_distinct("day").alias("days"))),
                         ["column"])
    exact = explore.column_report(events.select(*_SKETCHED)).select("column", F.col("n_unique").alias("exact"))
    off = F.abs(F.col("n_unique") - F.col("exact"))
    return join_groups(united, settle(exact), ["column"]).select(
        "column", "rows", "non_null", "days", (off <= 4 * sketches.distinct_error() * F.col("exact")).alias("within"))


_HEAVY = ["l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_extendedprice"]


@query("heavy_values", " union all ".join(f"""select '{c}' as "column", value, n, total from (
  select cast({c} as {"bigint" if c == "l_quantity" else "varchar"})::varchar as value, count(*) as n, (select count({c}) from lineitem) as total
  from lineitem where {c} is not null group by 1) where n >= 0.005::double * total""" for c in _HEAVY))
def heavy_values(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("long"))
    return sketches.heavy_values(rows.select(*_HEAVY), _HEAVY, 0.005)


_CHECKED = [*S.BINARY_COLUMNS, "PaymentMethod", "InternetService"]


@query("binary_check", " union all ".join(
    f"select '{c}' as \"column\", bool_and(coalesce({c} in ('Yes', 'No'), false)) as is_binary from subscribers" for c in _CHECKED), SUB)
def binary_check(spark, sf):
    return explore.binary_check(subscribers(spark, sf), _CHECKED)


@query("non_numeric_count", f"""
select count(*) as non_numeric from subscribers where TotalCharges is not null and {_TOTAL} is null""", SUB)
def non_numeric_count(spark, sf):
    return explore.non_numeric_count(subscribers(spark, sf), "TotalCharges")


_STATUS = ["F", "O", "P"]


@query("crosstab", "select o_orderpriority, " + ", ".join(
    f"count(*) filter (o_orderstatus = '{v}') as \"{v}\"" for v in _STATUS)
    + " from orders where o_orderpriority is not null and o_orderstatus is not null group by 1")
def crosstab(spark, sf):
    return explore.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", _STATUS)


@query("crosstab_pct", "select o_orderpriority, " + ", ".join(
    f"round(count(*) filter (o_orderstatus = '{v}') * 100.0 / count(*) filter (o_orderstatus in ('F', 'O', 'P')), 6) as \"{v}\"" for v in _STATUS)
    + " from orders where o_orderpriority is not null and o_orderstatus is not null group by 1")
def crosstab_pct(spark, sf):
    return rounded(explore.crosstab_pct(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", _STATUS))


_SEGMENT = """case when Contract = 'Month-to-month' and tenure < 12 and MonthlyCharges > 70 then 'High'
  when Contract = 'One year' or tenure between 12 and 24 then 'Medium'
  when Contract = 'Two year' and tenure > 24 then 'Low' else 'Other' end"""


@query("segment_profile", f"""
select {_SEGMENT} as segment, count(*) as subscribers, round(avg(tenure), 6) as mean_tenure,
  round(avg(MonthlyCharges), 6) as mean_charge, round(avg(case when Churn = 'Yes' then 1 else 0 end) * 100, 6) as churn_rate
from subscribers group by 1""", SUB)
def segment_profile(spark, sf):
    return rounded(explore.segment_profile(subscribers(spark, sf).withColumn("segment", explore.rule_segment()), "segment"))


@query("rule_segment", f"select customerID, {_SEGMENT} as segment from subscribers", SUB)
def rule_segment(spark, sf):
    return subscribers(spark, sf).select(S.KEY, explore.rule_segment().alias("segment"))


@query("correlation", " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as r from lineitem"
    for a in LINE_NUMBERS for b in LINE_NUMBERS))
def correlation(spark, sf):
    return rounded(explore.correlation(table(spark, sf, "lineitem"), LINE_NUMBERS))


_GAPS = {"l_quantity": "l_linenumber = 3", "l_tax": "l_orderkey % 5 = 0", "l_discount": "l_linenumber = 2"}


@query("correlation_blocks", "with l as (select * replace (" + ", ".join(
    f"case when not ({gap}) then {c} end as {c}" for c, gap in _GAPS.items()) + ") from lineitem) " + " union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, count(*) filter ({a} is not null and {b} is not null) as n, round(corr({a}, {b}), 6) as r from l"
    for a in LINE_NUMBERS for b in LINE_NUMBERS))
def correlation_blocks(spark, sf):
    """Some values are blanked, so that pairs differ in their rows."""
    rows = table(spark, sf, "lineitem").withColumns({c: F.when(~F.expr(gap), F.col(c)) for c, gap in _GAPS.items()})
    return rounded(wide.correlation_blocks(rows, LINE_NUMBERS))


@query("box_stats", """
with q as (select l_returnflag, quantile_cont(l_extendedprice, 0.25) q25, quantile_cont(l_extendedprice, 0.5) q50,
  quantile_cont(l_extendedprice, 0.75) q75 from lineitem group by 1),
r as (select l.l_returnflag, l_extendedprice x, q25, q50, q75, l_extendedprice between q25 - 1.5*(q75-q25) and q75 + 1.5*(q75-q25) inside
  from lineitem l join q on l.l_returnflag = q.l_returnflag)
select l_returnflag, round(q25, 6) as q25, round(q50, 6) as q50, round(q75, 6) as q75, count(*) as n,
  round(min(x) filter (inside), 6) as low_whisker, round(max(x) filter (inside), 6) as high_whisker,
  count(*) filter (not inside) as outliers from r group by l_returnflag, r.q25, r.q50, r.q75""")
def box_stats(spark, sf):
    return rounded(explore.box_stats(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"]))


@query("histogram", """
with b as (select min(l_extendedprice) lo, (max(l_extendedprice) - min(l_extendedprice)) / 30 w from lineitem),
c as (select cast(least(floor((l_extendedprice - lo) / w), 29) as int) as bin, count(*) n from lineitem, b group by 1)
select cast(i as int) as bin, round(lo + i * w, 6) as bin_from, round(lo + (i + 1) * w, 6) as bin_to, coalesce(n, 0) as n
from range(30) r(i) cross join b left join c on c.bin = i""")
def histogram(spark, sf):
    return rounded(explore.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30))


@query("imbalance_ratio", """
select min(n) as smallest, max(n) as largest, round(min(n) / max(n), 6) as ratio from (select count(*) n from subscribers group by Churn)""", SUB)
def imbalance_ratio(spark, sf):
    return rounded(explore.imbalance_ratio(subscribers(spark, sf), "Churn"))


@query("headline_kpis", """, q as (select quantile_cont(MonthlyCharges, 0.8) t from subscribers)
select round(avg(case when Churn = 'Yes' then 1 else 0 end) * 100, 6) as churn_rate,
  round(avg(case when Churn = 'Yes' then 1 else 0 end) filter (MonthlyCharges > (select t from q)) * 100, 6) as high_value_churn_rate,
  round(avg(tenure), 6) as mean_tenure, round(avg(MonthlyCharges), 6) as mean_charge from subscribers""", SUB)
def headline_kpis(spark, sf):
    return rounded(explore.headline_kpis(subscribers(spark, sf)))


@query("scatter_sample", """
select tenure, MonthlyCharges, Churn from subscribers
where cast(('0x' || substr(md5(concat(customerID, ':42')), 1, 8)) as bigint) / 4294967296.0 < 0.2""", ("subscribers",))
def scatter_sample(spark, sf):
    return explore.scatter_sample(subscribers(spark, sf), ["tenure", "MonthlyCharges"], "Churn", 0.2)


@query("risk_distribution", """
select case when score < 0.3 then 'Low' when score < 0.7 then 'Medium' else 'High' end as value, count(*) as n from scored group by 1""", SCO)
def risk_distribution(spark, sf):
    return explore.value_counts(scored(spark, sf).select(risk_level("score").alias("risk")), "risk")


_WINDOWS = """w as (select cast(floor(event_id / 100) as bigint) as window_id, count(*) as messages,
  count(*) filter (json_valid(value)) as predictions, count(*) filter (not json_valid(value)) as errors from messages group by 1)"""


@query("count_windows", f", {_WINDOWS} select window_id, messages, predictions, errors from w", ("messages",))
def count_windows(spark, sf):
    return window_counts(messages(spark, sf), S.event_schema(), "event_id")


@query("batch_summary", f""", {_WINDOWS} select count(*) as windows, cast(sum(messages) as bigint) as messages,
  cast(sum(predictions) as bigint) as predictions, cast(sum(errors) as bigint) as errors,
  round(sum(predictions) * 100.0 / sum(messages), 6) as success_pct, sum(predictions) * 100.0 / sum(messages) >= 95 as passed from w""", ("messages",))
def batch_summary_query(spark, sf):
    return rounded(batch_summary(window_counts(messages(spark, sf), S.event_schema(), "event_id")))


# --- run log: one run per (contract, scorecard), derived from the scored subscribers --------------------------------

_RUNS = """l as (select s.Contract, m.* from subscribers s join model_scores m using (customerID)),
u as (select Contract || ':a' run_id, 'a' model, label, score_a s from l union all select Contract || ':b', 'b', label, score_b from l
  union all select Contract || ':c', 'c', label, score_c from l),
r as (select run_id, model, round(avg(case when (s >= 0.5) = (label = 1) then 1.0 else 0.0 end), 6) accuracy, count(*) n from u group by all)"""


def run_log(spark, sf):
    rows = model_scores(spark, sf).join(subscribers(spark, sf).select(S.KEY, "Contract"), S.KEY)
    long = long_scores(rows, {"a": "score_a", "b": "score_b", "c": "score_c"}, [S.KEY, "label", "Contract"])
    return (long.groupBy(F.concat_ws(":", "Contract", "model").alias("run_id"), "model")
            .agg(F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 6).alias("accuracy"), F.count("*").alias("n"))
            .select("run_id", "model", F.create_map(F.lit("contract"), F.split("run_id", ":")[0]).alias("params"),
                    F.create_map(F.lit("accuracy"), F.col("accuracy"), F.lit("n"), F.col("n").cast("double")).alias("metrics")))


def versions(spark, sf):
    """A version number per run of a model."""
    return runs.number_versions(run_log(spark, sf).select("run_id", "model"), "model", "run_id")


@query("runs_best", f""", {_RUNS}, v as (select run_id, cast(row_number() over (partition by model order by run_id) as int) as version from r)
select r.run_id, model, accuracy, version from r join v using (run_id) order by accuracy desc, run_id limit 1""", ("subscribers", "model_scores"))
def runs_best(spark, sf):
    best = runs.best_version(run_log(spark, sf), versions(spark, sf).drop("model"), "accuracy")
    return best.select("run_id", "model", "accuracy", "version")


@query("newest_versions", f""", {_RUNS}, v as (select run_id, model, cast(row_number() over (partition by model order by run_id) as int) as version from r)
select run_id, model, version, case when row_number() over (partition by model order by version desc) <= 2 then 'Active'
  else 'Archived' end as stage from v""", ("subscribers", "model_scores"))
def newest_versions(spark, sf):
    return runs.mark_versions(versions(spark, sf), "model", "version", 2).select("run_id", "model", "version", "stage")


# --- splits, folds, balancing --------------------------------------------------------------------------------------

def _u(key: str, seed: str) -> str:
    return f"cast(('0x' || substr(md5(concat({key}, ':{seed}')), 1, 8)) as bigint) / 4294967296.0"


@query("split_hash", f"select customerID, {_u('customerID', '42')} < 0.2 as is_test from subscribers", SUB)
def split_hash(spark, sf):
    return sampling.split_hash(subscribers(spark, sf).select(S.KEY), S.KEY)


@query("split_stratified", """
select customerID, label, row_number() over (partition by label order by md5(concat(customerID, ':42')), customerID)
  <= floor(count(*) over (partition by label) * 0.2 + 0.5) as is_test from scored""", SCO)
def split_stratified(spark, sf):
    return sampling.split_stratified(scored(spark, sf).select(S.KEY, "label"), S.KEY, ["label"])


@query("folds_stratified", """
select customerID, label, cast((row_number() over (partition by label order by md5(concat(customerID, ':42')), customerID) - 1) % 5 as int) as fold
from scored""", SCO)
def folds_stratified(spark, sf):
    return sampling.folds_stratified(scored(spark, sf).select(S.KEY, "label"), S.KEY, ["label"])


@query("folds_plain", """
select l_orderkey, l_linenumber, cast((row_number() over (order by md5(concat(k, ':42')), k) - 1) % 5 as int) as fold
from (select l_orderkey, l_linenumber, concat(l_orderkey, '-', l_linenumber) k from lineitem)""")
def folds_plain(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("k"))
    return sampling.folds_plain(rows, "k").drop("k")


@query("folds_time", """
with r as (select event_id, ts, row_number() over (order by ts, event_id) - 1 i, count(*) over () n from events),
b as (select *, n // 6 size, n - 5 * (n // 6) first_size from r)
select event_id, ts, cast(case when i < first_size then 0 else floor((i - first_size) / size) + 1 end as int) as block from b""")
def folds_time(spark, sf):
    return sampling.folds_time(table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"], 5)


@query("oversample", """, c as (select label, count(*) n from scored group by 1), m as (select max(n) t from c),
r as (select customerID, s.label, n, t, row_number() over (partition by s.label order by md5(concat(customerID, ':42')), customerID) i
  from scored s join c on c.label = s.label, m)
select customerID, label, cast(unnest(range(t // n + case when i <= t % n then 1 else 0 end)) as int) as copy from r""", SCO)
def oversample(spark, sf):
    return sampling.oversample(scored(spark, sf).select(S.KEY, "label"), S.KEY, "label")


@query("undersample", """, c as (select label, count(*) n from scored group by 1)
select customerID, label from (select *, row_number() over (partition by label order by md5(concat(customerID, ':42')), customerID) i from scored)
where i <= (select min(n) from c)""", SCO)
def undersample(spark, sf):
    return sampling.undersample(scored(spark, sf).select(S.KEY, "label"), S.KEY, "label")


@query("class_weights", """
select customerID, label, round(count(*) over () / (2.0 * count(*) over (partition by label)), 6) as weight from scored""", SCO)
def class_weights(spark, sf):
    return rounded(sampling.class_weights(scored(spark, sf).select(S.KEY, "label"), "label"))


@query("sample_n", "select customerID, tenure from subscribers order by md5(concat(customerID, ':42')), customerID limit 100", SUB)
def sample_n(spark, sf):
    return sampling.sample_n(subscribers(spark, sf).select(S.KEY, "tenure"), S.KEY, 100)

"""Queries over sources, cleaning and features."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.catalog.registry import query, rounded
from stayline.functions.binning import risk_level, risk_level_cut
from stayline.functions.scalars import currency, iso_timestamp, run_stamp
from stayline.operators import clean, features
from stayline.plans.durable import work_path
from stayline.sources import tables
from stayline.sources.fixtures import messages, scored, subscribers, table
from stayline.streaming.messages import count_window, decode, undecodable

SUB = ("subscribers",)
COLUMNS = ", ".join(f.name for f in S.subscriber_schema().fields)
def edge_time():
    """A fixed stand-in for "now", so that results repeat."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def coerced(spark, sf):
    return clean.coerce_numeric(subscribers(spark, sf), ["TotalCharges"])


# --- sources and sinks -------------------------------------------------------------------------------------------

@query("scan_subscribers", f"select {COLUMNS} from subscribers", SUB)
def scan_subscribers(spark, sf):
    path = work_path(spark, "scan")
    tables.write_csv(subscribers(spark, sf), path)
    return tables.read_csv(spark, path, S.subscriber_schema())


@query("roundtrip_csv", """
select customerID, tenure, round(MonthlyCharges, 6) MonthlyCharges, round(try_cast(trim(TotalCharges) as double), 6) TotalCharges,
  PaymentMethod, case when Churn = 'Yes' then 1 else 0 end as label from subscribers
where try_cast(trim(TotalCharges) as double) is not null""", SUB)
def roundtrip_csv(spark, sf):
    cleaned = clean.clean_subscribers(subscribers(spark, sf)).select(
        "customerID", "tenure", "MonthlyCharges", "TotalCharges", "PaymentMethod", "label")
    path = work_path(spark, "cleaned")
    tables.write_csv(cleaned, path)
    return rounded(tables.read_csv(spark, path, cleaned.schema))


@query("encode_messages", """
select cast(user_id as varchar) as key, cast(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type,
  'value': case when event_id % 7 = 0 then null else value end, 'event_ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')}) as varchar) as value
from events""")
def encode_messages(spark, sf):
    events = table(spark, sf, "events")
    rows = events.withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    keyed = rows.select("event_id", "user_id", "event_type", "value", iso_timestamp("ts").alias("event_ts"))
    return tables.encode_json(keyed, "user_id")


@query("decode_messages", """
select event_id, coalesce(key, json_extract_string(value, '$.customerID')) as key,
  json_extract_string(value, '$.customerID') as "customerID", json_extract_string(value, '$.event_ts') as event_ts,
  json_extract_string(value, '$.event_type') as event_type, cast(json_extract(value, '$.value') as double) as value
from messages where json_valid(value)""", ("messages",))
def decode_messages(spark, sf):
    return decode(messages(spark, sf), S.event_schema(), edge_time())


@query("dead_letters", """
select event_id, key, value as original_message, 'value is not valid JSON' as error, 'decode' as stage,
  '2024-01-01T00:00:00.000000' as failed_at from messages where not json_valid(value)""", ("messages",))
def dead_letters(spark, sf):
    return undecodable(messages(spark, sf), S.event_schema(), iso_timestamp(edge_time()))


@query("replay_chunks", """
select cast(floor(event_id / 100) as bigint) as chunk, count(*) as messages, min(event_id) as first_id, max(event_id) as last_id
from messages group by 1""", ("messages",))
def replay_chunks(spark, sf):
    return messages(spark, sf).groupBy(count_window("event_id", 100).alias("chunk")).agg(
        F.count("*").alias("messages"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("sample_feed", """, d as (select customerID,
  cast(('0x' || substr(md5(concat(customerID, ':42')), 1, 8)) as bigint) / 4294967296.0 u from subscribers),
t as (select customerID, unnest(range(0, case when u >= exp(-0.1) then 1 else 0 end + case when u >= exp(-0.1) * 1.1 then 1 else 0 end
  + case when u >= exp(-0.1) * 1.105 then 1 else 0 end + case when u >= exp(-0.1) * (1.105 + 0.001 / 6) then 1 else 0 end
  + case when u >= exp(-0.1) * (1.105 + 0.001 / 6 + 0.0001 / 24) then 1 else 0 end)) i from d)
select customerID as "key", customerID as customer, tenure as tenure from t join subscribers using (customerID)""", SUB)
def sample_feed(spark, sf):
    sent = tables.sample_messages(subscribers(spark, sf).drop(S.TARGET), S.KEY, 0.1, iso_timestamp(edge_time()))
    return sent.select("key", F.get_json_object("value", "$.customerID").alias("customer"),
                       F.get_json_object("value", "$.tenure").cast("int").alias("tenure"))


# --- cleaning ----------------------------------------------------------------------------------------------------

@query("coerce_numeric", "select customerID, round(try_cast(trim(TotalCharges) as double), 6) as TotalCharges from subscribers", SUB)
def coerce_numeric(spark, sf):
    return rounded(coerced(spark, sf).select(S.KEY, "TotalCharges"))


@query("drop_null_rows", """
select customerID, round(try_cast(trim(TotalCharges) as double), 6) as TotalCharges from subscribers
where try_cast(trim(TotalCharges) as double) is not null""", SUB)
def drop_null_rows(spark, sf):
    return rounded(clean.drop_null_rows(coerced(spark, sf), ["TotalCharges"]).select(S.KEY, "TotalCharges"))


@query("drop_any_null", """
select customerID, PaymentMethod, round(try_cast(trim(TotalCharges) as double), 6) as TotalCharges from subscribers
where try_cast(trim(TotalCharges) as double) is not null and PaymentMethod is not null""", SUB)
def drop_any_null(spark, sf):
    return rounded(clean.drop_null_rows(coerced(spark, sf)).select(S.KEY, "PaymentMethod", "TotalCharges"))


@query("encode_label", """
select customerID, case Churn when 'Yes' then 1 when 'No' then 0 end as label,
  case PaymentMethod when 'Yes' then 1 when 'No' then 0 end as other from subscribers""", SUB)
def encode_label(spark, sf):
    df = clean.encode_label(subscribers(spark, sf))
    return clean.encode_label(df, "PaymentMethod", "other").select(S.KEY, "label", "other")


@query("fill_constant", """
select customerID, round(coalesce(try_cast(trim(TotalCharges) as double), 0), 6) as TotalCharges from subscribers""", SUB)
def fill_constant(spark, sf):
    return rounded(clean.fill_constant(coerced(spark, sf), {"TotalCharges": 0.0}).select(S.KEY, "TotalCharges"))


@query("impute_median", """, t as (select customerID, try_cast(trim(TotalCharges) as double) x from subscribers)
select customerID, round(coalesce(x, (select quantile_cont(x, 0.5) from t)), 6) as TotalCharges from t""", SUB)
def impute_median(spark, sf):
    return rounded(clean.impute_median(coerced(spark, sf).select(S.KEY, "TotalCharges"), ["TotalCharges"]))


@query("impute_mean", """, t as (select customerID, try_cast(trim(TotalCharges) as double) x, MonthlyCharges from subscribers)
select customerID, round(coalesce(MonthlyCharges, (select avg(MonthlyCharges) from t)), 6) as MonthlyCharges,
  round(coalesce(x, (select avg(x) from t)), 6) as TotalCharges from t""", SUB)
def impute_mean(spark, sf):
    return rounded(clean.impute_mean(coerced(spark, sf).select(S.KEY, "MonthlyCharges", "TotalCharges"),
                                     ["MonthlyCharges", "TotalCharges"]))


@query("impute_mode", """
select customerID, coalesce(PaymentMethod, (select PaymentMethod from subscribers where PaymentMethod is not null
  group by 1 order by count(*) desc, 1 limit 1)) as PaymentMethod from subscribers""", SUB)
def impute_mode(spark, sf):
    return clean.impute_mode(subscribers(spark, sf).select(S.KEY, "PaymentMethod"), ["PaymentMethod"])


@query("align_schema", """
select customerID, cast(null as double) as LoyaltyScore, tenure, try_cast(trim(TotalCharges) as double) as TotalCharges,
  cast(null as varchar) as Region from subscribers""", SUB)
def align_schema(spark, sf):
    wanted = T.StructType([
        T.StructField(S.KEY, T.StringType()), T.StructField("LoyaltyScore", T.DoubleType()),
        T.StructField("tenure", T.IntegerType()), T.StructField("TotalCharges", T.DoubleType()),
        T.StructField("Region", T.StringType())])
    return clean.align_schema(subscribers(spark, sf), wanted)


@query("validate_rows", """
select customerID, case when try_cast(trim(TotalCharges) as double) is null then 'TotalCharges is not numeric' end as error
from subscribers""", SUB)
def validate_rows(spark, sf):
    return clean.validate_rows(subscribers(spark, sf), S.CATEGORICAL_FEATURES, S.NUMERIC_FEATURES).select(S.KEY, "error")


@query("high_value_filter", """
select customerID, MonthlyCharges from subscribers
where MonthlyCharges > (select quantile_cont(MonthlyCharges, 0.8) from subscribers)""", SUB)
def high_value_filter(spark, sf):
    return clean.above_quantile(subscribers(spark, sf).select(S.KEY, "MonthlyCharges"), "MonthlyCharges", 0.8)


@query("cast_flag", "select customerID, SeniorCitizen <> 0 as SeniorCitizen from subscribers", SUB)
def cast_flag(spark, sf):
    return clean.cast_flag(subscribers(spark, sf).select(S.KEY, "SeniorCitizen"), ["SeniorCitizen"])


# --- features ----------------------------------------------------------------------------------------------------

def _tenure_sql(out: str, rules: list[tuple[str, str]]) -> str:
    cases = " ".join(f"when {test} then '{label}'" for test, label in rules)
    return f"select customerID, tenure, case {cases} end as {out} from subscribers"


@query("tenure_group_dag", _tenure_sql("tenure_group", [
    ("tenure between 0 and 12", "0-12"), ("tenure between 13 and 24", "13-24"), ("tenure between 25 and 48", "25-48"),
    ("tenure between 49 and 72", "49-72")]), SUB)
def tenure_group_dag(spark, sf):
    return features.add_tenure_group(subscribers(spark, sf).select(S.KEY, "tenure"), "prepared")


@query("tenure_group_prep", _tenure_sql("tenure_group", [
    ("tenure between 1 and 12", "0-12"), ("tenure between 13 and 24", "12-24"), ("tenure between 25 and 36", "24-36"),
    ("tenure between 37 and 48", "36-48"), ("tenure between 49 and 60", "48-60"), ("tenure > 60", "60+")]), SUB)
def tenure_group_prep(spark, sf):
    return features.add_tenure_group(subscribers(spark, sf).select(S.KEY, "tenure"), "model")


@query("tenure_category", _tenure_sql("tenure_category", [
    ("tenure between 1 and 12", "Short-term"), ("tenure between 13 and 24", "Mid-term"),
    ("tenure between 25 and 48", "Long-term"), ("tenure between 49 and 60", "Very-long-term"), ("tenure > 60", "Loyal")]), SUB)
def tenure_category(spark, sf):
    return features.add_tenure_group(subscribers(spark, sf).select(S.KEY, "tenure"), "category", "tenure_category")


@query("tenure_group_left", _tenure_sql("tenure_group", [
    ("tenure between 0 and 11", "1-12"), ("tenure between 12 and 23", "13-24"), ("tenure between 24 and 35", "25-36"),
    ("tenure between 36 and 47", "37-48"), ("tenure between 48 and 59", "49-60"), ("tenure between 60 and 71", "61-72")]), SUB)
def tenure_group_left(spark, sf):
    return features.add_tenure_group(subscribers(spark, sf).select(S.KEY, "tenure"), "left")


@query("risk_level", """
select customerID, score, case when score < 0.3 then 'Low' when score < 0.7 then 'Medium' else 'High' end as risk_level
from scored""", ("subscribers", "scored"))
def risk_level_query(spark, sf):
    return scored(spark, sf).select(S.KEY, "score", risk_level("score").alias("risk_level"))


@query("risk_level_cut", """
select customerID, score, case when score > 0 and score <= 0.3 then 'Low' when score > 0.3 and score <= 0.7 then 'Medium'
  when score > 0.7 and score <= 1 then 'High' end as risk_level from scored""", ("subscribers", "scored"))
def risk_level_cut_query(spark, sf):
    return scored(spark, sf).select(S.KEY, "score", risk_level_cut("score").alias("risk_level"))


_YES = " + ".join(f"case when {c} = 'Yes' then 1 else 0 end" for c in S.SERVICE_COLUMNS)


@query("num_services", f"select customerID, {_YES} as num_services from subscribers", SUB)
def num_services(spark, sf):
    return features.add_service_features(subscribers(spark, sf)).select(S.KEY, "num_services")


@query("has_streaming", """
select customerID, case when StreamingTV = 'Yes' or StreamingMovies = 'Yes' then 1 else 0 end as has_streaming from subscribers""", SUB)
def has_streaming(spark, sf):
    return features.add_service_features(subscribers(spark, sf)).select(S.KEY, "has_streaming")


_NAMED = ["PhoneService", "InternetService", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"]
_NOT_NO = " + ".join(f"case when {c} is distinct from 'No' then 1 else 0 end" for c in _NAMED)


@query("service_count", f"select customerID, {_NOT_NO} as service_count from subscribers", SUB)
def service_count(spark, sf):
    return features.add_service_count(subscribers(spark, sf)).select(S.KEY, "service_count")


@query("has_internet", """
select customerID, case when InternetService is distinct from 'No' then 1 else 0 end as "HasInternetService" from subscribers""", SUB)
def has_internet(spark, sf):
    return subscribers(spark, sf).select(S.KEY, features.has_internet().alias("HasInternetService"))


@query("has_security", """
select customerID, case when OnlineSecurity = 'Yes' or OnlineBackup = 'Yes' or DeviceProtection = 'Yes' or TechSupport = 'Yes'
  then 1 else 0 end as "HasSecurityProtection" from subscribers""", SUB)
def has_security(spark, sf):
    return subscribers(spark, sf).select(S.KEY, features.has_security().alias("HasSecurityProtection"))


_NUM = "t as (select customerID, tenure, Contract, MonthlyCharges, try_cast(trim(TotalCharges) as double) TotalCharges from subscribers)"


@query("charge_ratios", f""", {_NUM}
select customerID, coalesce(MonthlyCharges / nullif(tenure, 0), 0) as monthly_per_tenure,
  coalesce(TotalCharges / nullif(tenure, 0), 0) as total_per_tenure from t""", SUB)
def charge_ratios(spark, sf):
    return features.add_charge_ratios(coerced(spark, sf)).select(S.KEY, "monthly_per_tenure", "total_per_tenure")


@query("avg_monthly_charge", f", {_NUM} select customerID, TotalCharges / (tenure + 1) as avg_monthly_charge from t", SUB)
def avg_monthly_charge(spark, sf):
    return coerced(spark, sf).select(S.KEY, features.avg_monthly_charge().alias("avg_monthly_charge"))


@query("avg_charge_guarded", f""", {_NUM}
select customerID, case when tenure > 0 then TotalCharges / tenure else 0.0 end as avg_charge from t""", SUB)
def avg_charge_guarded(spark, sf):
    return coerced(spark, sf).select(S.KEY, features.avg_charge_guarded().alias("avg_charge"))


@query("interaction", "select customerID, tenure * MonthlyCharges as tenure_charge from subscribers", SUB)
def interaction(spark, sf):
    return subscribers(spark, sf).select(S.KEY, features.tenure_charge().alias("tenure_charge"))


@query("vs_group_avg", """
select customerID, Contract, round(MonthlyCharges - avg(MonthlyCharges) over (partition by Contract), 6) as charge_vs_contract
from subscribers""", SUB)
def vs_group_avg(spark, sf):
    df = subscribers(spark, sf).select(S.KEY, "Contract", "MonthlyCharges")
    return rounded(features.vs_group_mean(df, "MonthlyCharges", "Contract", "charge_vs_contract").drop("MonthlyCharges"))


@query("iqr_clip", f""", {_NUM},
b as (select quantile_cont(MonthlyCharges, 0.25) m1, quantile_cont(MonthlyCharges, 0.75) m3,
  quantile_cont(TotalCharges, 0.25) t1, quantile_cont(TotalCharges, 0.75) t3 from t)
select customerID, round(greatest(least(MonthlyCharges, m3 + 1.5*(m3-m1)), m1 - 1.5*(m3-m1)), 6) as MonthlyCharges,
  case when TotalCharges is not null then round(greatest(least(TotalCharges, t3 + 1.5*(t3-t1)), t1 - 1.5*(t3-t1)), 6) end as TotalCharges
from t, b""", SUB)
def iqr_clip(spark, sf):
    df = coerced(spark, sf).select(S.KEY, "MonthlyCharges", "TotalCharges")
    return rounded(features.iqr_clip(df, ["MonthlyCharges", "TotalCharges"]))


@query("standardize", """
select customerID, round((tenure - (select avg(tenure) from subscribers)) / (select stddev_pop(tenure) from subscribers), 6) as tenure_z,
  round((MonthlyCharges - (select avg(MonthlyCharges) from subscribers)) / (select stddev_pop(MonthlyCharges) from subscribers), 6)
  as "MonthlyCharges_z" from subscribers""", SUB)
def standardize(spark, sf):
    df = subscribers(spark, sf).select(S.KEY, "tenure", "MonthlyCharges")
    return rounded(features.standardize(df, ["tenure", "MonthlyCharges"]).select(S.KEY, "tenure_z", "MonthlyCharges_z"))


@query("minmax_scale", """, b as (select min(tenure) a, max(tenure) b, min(MonthlyCharges) c, max(MonthlyCharges) d from subscribers)
select customerID, round((tenure - a) / (b - a), 6) as tenure_01, round((MonthlyCharges - c) / (d - c), 6) as "MonthlyCharges_01"
from subscribers, b""", SUB)
def minmax_scale(spark, sf):
    df = subscribers(spark, sf).select(S.KEY, "tenure", "MonthlyCharges")
    return rounded(features.minmax(df, ["tenure", "MonthlyCharges"]).select(S.KEY, "tenure_01", "MonthlyCharges_01"))


@query("string_index", """, c as (select PaymentMethod p, row_number() over (order by PaymentMethod) - 1 i from
  (select distinct PaymentMethod from subscribers where PaymentMethod is not null))
select customerID, PaymentMethod, cast(coalesce(i, (select count(*) from c)) as double) as payment_index
from subscribers left join c on p = PaymentMethod""", SUB)
def string_index(spark, sf):
    return features.string_index(subscribers(spark, sf).select(S.KEY, "PaymentMethod"), "PaymentMethod", "payment_index")


@query("one_hot", """
select customerID, case when Contract = 'Month-to-month' then 1 else 0 end as "Contract=Month-to-month",
  case when Contract = 'One year' then 1 else 0 end as "Contract=One year",
  case when Contract = 'Two year' then 1 else 0 end as "Contract=Two year",
  case when InternetService = 'Fiber optic' then 1 else 0 end as "InternetService=Fiber optic",
  case when InternetService = 'No' then 1 else 0 end as "InternetService=No" from subscribers""", SUB)
def one_hot(spark, sf):
    df = subscribers(spark, sf).select(S.KEY, "Contract", "InternetService")
    return features.one_hot_columns(features.one_hot_columns(df, "Contract"), "InternetService", drop_first=True).drop(
        "Contract", "InternetService")


@query("prepared_table", f""", {_NUM}, p as (select s.*, t.TotalCharges total from subscribers s join t using (customerID)
  where t.TotalCharges is not null)
select customerID, total as "TotalCharges", case when Churn = 'Yes' then 1 else 0 end as label,
  case when tenure between 1 and 12 then 'Short-term' when tenure between 13 and 24 then 'Mid-term'
    when tenure between 25 and 48 then 'Long-term' when tenure between 49 and 60 then 'Very-long-term'
    when tenure > 60 then 'Loyal' end as tenure_category,
  case when tenure between 0 and 12 then '0-12' when tenure between 13 and 24 then '13-24'
    when tenure between 25 and 48 then '25-48' when tenure between 49 and 72 then '49-72' end as tenure_group,
  {_YES} as num_services, {_NOT_NO} as service_count,
  coalesce(MonthlyCharges / nullif(tenure, 0), 0) as monthly_per_tenure,
  total / (tenure + 1) as avg_monthly_charge, tenure * MonthlyCharges as tenure_charge
from p""", SUB)
def prepared_table(spark, sf):
    return features.prepare_table(subscribers(spark, sf)).select(
        S.KEY, "TotalCharges", "label", "tenure_category", "tenure_group", "num_services", "service_count",
        "monthly_per_tenure", "avg_monthly_charge", "tenure_charge")


# --- scalar functions --------------------------------------------------------------------------------------------

@query("format_currency", """
select o_orderkey, concat('$', format('{:,.2f}', o_totalprice)) as price from orders""")
def format_currency(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", currency("o_totalprice").alias("price"))


@query("iso_timestamps", """
select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as iso, strftime(ts, '%Y%m%d_%H%M%S') as stamp from events""")
def iso_timestamps(spark, sf):
    return table(spark, sf, "events").select("event_id", iso_timestamp("ts").alias("iso"), run_stamp("ts").alias("stamp"))

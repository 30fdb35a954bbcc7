"""Subscribers, scores and messages derived from the star-schema tables.

The SQL below is valid in Spark and in DuckDB; Spark reads ``{orders}``-style names as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SUBSCRIBERS_SQL = """
with o as (
  select o_custkey, min(o_orderdate) f, max(o_orderdate) l, sum(o_totalprice) tot
  from {orders} group by o_custkey),
b as (
  select c.c_custkey k, c.c_mktsegment seg, c.c_acctbal bal, o.l, coalesce(o.tot, 0) tot,
         coalesce((year(o.l)*12+month(o.l)) - (year(o.f)*12+month(o.f)), 0) tenure
  from {customer} c left join o on o.o_custkey = c.c_custkey)
select cast(k as string) customerID,
  case when k%2=0 then 'Female' else 'Male' end gender,
  case when k%6=0 then 1 else 0 end SeniorCitizen,
  case when k%5<2 then 'Yes' else 'No' end Partner,
  case when k%7<2 then 'Yes' else 'No' end Dependents,
  cast(tenure as int) tenure,
  case when k%10<9 then 'Yes' else 'No' end PhoneService,
  case when k%10=9 then 'No phone service' when k%4<2 then 'Yes' else 'No' end MultipleLines,
  case k%3 when 0 then 'DSL' when 1 then 'Fiber optic' else 'No' end InternetService,
  case when k%3=2 then 'No internet service' when k%11<5  then 'Yes' else 'No' end OnlineSecurity,
  case when k%3=2 then 'No internet service' when k%13<6  then 'Yes' else 'No' end OnlineBackup,
  case when k%3=2 then 'No internet service' when k%17<8  then 'Yes' else 'No' end DeviceProtection,
  case when k%3=2 then 'No internet service' when k%19<9  then 'Yes' else 'No' end TechSupport,
  case when k%3=2 then 'No internet service' when k%23<11 then 'Yes' else 'No' end StreamingTV,
  case when k%3=2 then 'No internet service' when k%29<14 then 'Yes' else 'No' end StreamingMovies,
  case seg when 'BUILDING' then 'Month-to-month' when 'MACHINERY' then 'Month-to-month'
           when 'AUTOMOBILE' then 'One year' when 'HOUSEHOLD' then 'One year' else 'Two year' end Contract,
  case when k%31<18 then 'Yes' else 'No' end PaperlessBilling,
  case when k%97=0 then null when k%37%4=0 then 'Electronic check' when k%37%4=1 then 'Mailed check'
       when k%37%4=2 then 'Bank transfer (automatic)' else 'Credit card (automatic)' end PaymentMethod,
  round(tot/(tenure+1)/1000, 2) MonthlyCharges,
  case when bal < -900 then ' ' else cast(round(tot/1000, 2) as string) end TotalCharges,
  case when l is null or l < timestamp '2001-01-01 00:00:00' then 'Yes' else 'No' end Churn
from b
"""

SCORED_SQL = """
select customerID, tenure, Contract, MonthlyCharges,
  case when Churn='Yes' then 1 else 0 end label, score,
  case when score >= 0.5 then 1 else 0 end prediction
from (select *, round(1.0/(1.0+exp(-(2.2 - 0.045*tenure + 0.004*MonthlyCharges
        + case when Contract='Month-to-month' then 0.6 else 0.0 end))), 6) score
      from {subscribers}) t
"""

# Three scorecards that differ in their intercept, for comparing and voting.
MODELS_SQL = """
select customerID, label, score_a, score_b, score_c from (
  select customerID, case when Churn='Yes' then 1 else 0 end label,
    round(1.0/(1.0+exp(-( 2.2 - 0.045*tenure + 0.004*MonthlyCharges + bonus))), 6) score_a,
    round(1.0/(1.0+exp(-( 1.5 - 0.030*tenure + 0.002*MonthlyCharges + bonus))), 6) score_b,
    round(1.0/(1.0+exp(-( 3.0 - 0.060*tenure + 0.001*MonthlyCharges))), 6) score_c
  from (select *, case when Contract='Month-to-month' then 0.6 else 0.0 end bonus from {subscribers}) s) t
"""

MESSAGES_DUCK = """
select event_id,
  case when event_id%20=0 then null else cast(user_id as varchar) end as key,
  case when event_id%50=0 then '{bad' else cast(to_json({
    'customerID': cast(user_id as varchar), 'event_type': event_type, 'value': value,
    'event_ts': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')}) as varchar) end as value
from events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer in the full subscriber schema."""
    return spark.sql(SUBSCRIBERS_SQL, orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscribers with a label and a fixed linear score."""
    return spark.sql(SCORED_SQL, subscribers=subscribers(spark, sf_dir))


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three score columns per subscriber."""
    return spark.sql(MODELS_SQL, subscribers=subscribers(spark, sf_dir))


def messages_from_events(events: DataFrame, *also: Column) -> DataFrame:
    """(event_id, key, value) envelopes and the columns asked for; works on a table and on a stream."""
    payload = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("customerID"), "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_ts")))
    return events.select(
        "event_id",
        F.when(F.col("event_id") % 20 != 0, F.col("user_id").cast("string")).alias("key"),
        F.when(F.col("event_id") % 50 == 0, "{bad").otherwise(payload).alias("value"), *also)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(table(spark, sf_dir, "events"))


def duck_ctes(*names: str) -> str:
    """The fixtures as common table expressions for the comparison engine."""
    parts = {
        "subscribers": SUBSCRIBERS_SQL.format(orders="orders", customer="customer"),
        "scored": SCORED_SQL.format(subscribers="subscribers"),
        "model_scores": MODELS_SQL.format(subscribers="subscribers"),
        "messages": MESSAGES_DUCK,
    }
    return "with " + ",\n".join(f"{n} as ({parts[n]})" for n in names)

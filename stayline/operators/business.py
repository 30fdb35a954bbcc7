"""Customer value, campaign economics and revenue at risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.scalars import as_col, currency


def lifetime_value(revenue: Column | str, months: Column | float = S.LIFESPAN_MONTHS,
                   acquisition: Column | float = S.ACQUISITION_COST) -> Column:
    return as_col(revenue) * months - acquisition


def churn_cost(churners: Column | str, value: Column | float) -> Column:
    return as_col(churners) * value


def roi(gain: Column, cost: Column) -> Column:
    """(gain - cost) / cost, infinite when nothing was spent."""
    return F.when(cost == 0, F.lit(float("inf"))).otherwise((gain - cost) / F.nullif(cost, F.lit(0.0)))


def default_value() -> float:
    return S.MONTHLY_REVENUE * S.LIFESPAN_MONTHS - S.ACQUISITION_COST


def campaign(df: DataFrame, success: float = S.CAMPAIGN_SUCCESS, contact_cost: float = S.CONTACT_COST,
             value: float | None = None, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Targeted, saved, cost, revenue and return of contacting every predicted churner, from one aggregate."""
    clv = default_value() if value is None else value
    hit = F.count_if((F.col(label) == 1) & (F.col(prediction) == 1))
    counts = df.agg(F.count_if(F.col(label) == 1).alias("churners"),
                    F.count_if(F.col(prediction) == 1).alias("targeted"), hit.alias("hits"))
    costed = counts.select(
        "churners", "targeted", (F.col("hits") * success).alias("saved"), (F.col("targeted") * contact_cost).alias("cost"),
        (F.col("hits") * success * clv).alias("revenue_saved"))
    return costed.withColumn("roi", roi(F.col("revenue_saved"), F.col("cost")))


def impact_report(df: DataFrame, success: float = S.CAMPAIGN_SUCCESS, contact_cost: float = S.CONTACT_COST,
                  value: float | None = None) -> DataFrame:
    """The campaign beside the cost of doing nothing."""
    clv = default_value() if value is None else value
    return campaign(df, success, contact_cost, clv).select(
        F.lit(clv).alias("clv"), "churners", churn_cost("churners", clv).alias("unchecked_cost"), "targeted", "saved",
        "cost", "revenue_saved", "roi", (F.col("revenue_saved") - F.col("cost")).alias("net_benefit"))


def revenue_at_risk(truth: DataFrame, predicted: DataFrame, key: str = S.KEY, charge: str = "MonthlyCharges",
                    label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Charges of churners, and of churners that were flagged; the two tables meet on the key."""
    joined = truth.select(key, label, charge).join(predicted.select(key, prediction), key)
    lost, flagged = F.col(label) == 1, F.col(prediction) == 1
    sums = joined.agg(
        F.count("*").alias("total_customers"), F.count_if(lost).alias("actual_churners"),
        F.count_if(flagged).alias("predicted_churners"), F.count_if(lost & flagged).alias("correctly_identified"),
        F.round(F.coalesce(F.sum(F.when(lost, F.col(charge))), F.lit(0.0)), 2).alias("at_risk"),
        F.round(F.coalesce(F.sum(F.when(lost & flagged, F.col(charge))), F.lit(0.0)), 2).alias("saved"))
    return sums.select("total_customers", "actual_churners", "predicted_churners", "correctly_identified",
                       currency("at_risk").alias("total_revenue_at_risk"), currency("saved").alias("potential_revenue_saved"))

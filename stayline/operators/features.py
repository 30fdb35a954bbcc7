"""Derived subscriber features. Row-wise ones are plain expressions; fitted ones put literals into the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.binning import tenure_bin
from stayline.functions.scalars import clip, count_equal, count_not_equal, safe_ratio
from stayline.operators.clean import any_of, clean_subscribers
from stayline.plans.ordered import exact_quantiles, global_rank
from stayline.plans.small import join_groups, settle


def add_tenure_group(df: DataFrame, version: str, out: str = "tenure_group") -> DataFrame:
    return df.withColumn(out, tenure_bin("tenure", version))


def add_service_features(df: DataFrame) -> DataFrame:
    """num_services: subscribed extras; has_streaming: any streaming service."""
    return df.withColumns({
        "num_services": count_equal(S.SERVICE_COLUMNS, S.POSITIVE),
        "has_streaming": any_of(S.STREAMING_COLUMNS, S.POSITIVE).cast("int"),
    })


def service_named_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if any(part in c.lower() for part in S.SERVICE_NAME_PARTS)]


def add_service_count(df: DataFrame) -> DataFrame:
    """Columns named like a service whose value is anything but No; "No internet service" and null count."""
    return df.withColumn("service_count", count_not_equal(service_named_columns(df), S.NEGATIVE))


def has_internet() -> Column:
    return (~F.col("InternetService").eqNullSafe(F.lit(S.NEGATIVE))).cast("int")


def has_security() -> Column:
    return any_of(S.PROTECTION_COLUMNS, S.POSITIVE).cast("int")


def add_charge_ratios(df: DataFrame) -> DataFrame:
    """Charges per month of tenure; 0 where there is no tenure or no charge."""
    return df.withColumns({
        "monthly_per_tenure": safe_ratio("MonthlyCharges", "tenure"),
        "total_per_tenure": safe_ratio("TotalCharges", "tenure"),
    })


def avg_monthly_charge() -> Column:
    return F.col("TotalCharges") / (F.col("tenure") + 1)


def avg_charge_guarded() -> Column:
    return F.when(F.col("tenure") > 0, F.try_divide(F.col("TotalCharges"), F.col("tenure"))).otherwise(F.lit(0.0))


def tenure_charge() -> Column:
    return F.col("tenure") * F.col("MonthlyCharges")


def vs_group_mean(df: DataFrame, value: str, group: str, out: str) -> DataFrame:
    """Deviation from the mean of the row's group. Means are pre-aggregated, so a hot group is no hot task."""
    means = settle(df.groupBy(group).agg(F.avg(value).alias("_mean")))
    return join_groups(df, means, [group], "left").withColumn(out, F.col(value) - F.col("_mean")).drop("_mean")


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> dict[str, tuple[float, float]]:
    """Lower and upper fence per column from exact quartiles."""
    rows = exact_quantiles(df, columns, [0.25, 0.75]).collect()
    return {r["column"]: (r["q"][0] - factor * (r["q"][1] - r["q"][0]), r["q"][1] + factor * (r["q"][1] - r["q"][0]))
            for r in rows}


def iqr_clip(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    fences = iqr_bounds(df, columns, factor)
    return df.withColumns({c: clip(F.col(c).cast("double"), *fences[c]) for c in columns if c in fences})


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Centre and divide by the population deviation; a constant column becomes 0."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()
    return df.withColumns({
        f"{c}{suffix}": (F.col(c) - F.lit(stats[f"m_{c}"]).cast("double")) / F.lit(stats[f"s_{c}"] or 1.0) for c in columns})


def minmax(df: DataFrame, columns: Sequence[str], suffix: str = "_01") -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0."""
    stats = df.agg(*[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
                   *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns]).first()

    def scaled(c: str) -> Column:
        lo, hi = stats[f"lo_{c}"], stats[f"hi_{c}"]
        width = (hi - lo) if lo is not None and hi != lo else 1.0
        return (F.col(c) - F.lit(lo).cast("double")) / F.lit(width)

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def category_table(df: DataFrame, column: str) -> DataFrame:
    """(column, _place): distinct non-null values with their alphabetical position, numbered across tasks."""
    return global_rank(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], "_place")


def categories(df: DataFrame, column: str) -> list[str]:
    """Distinct non-null values in order, for results that have a column per value."""
    return sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())


def string_index(df: DataFrame, column: str, out: str) -> DataFrame:
    """Position in alphabetical order; null gets the number after the last. Any number of values: positions are joined."""
    places = category_table(df, column)
    return join_groups(df, places, [column], "left").withColumn(
        out, F.coalesce("_place", F.lit(places.count())).cast("double")).drop("_place")


def one_hot_vector(df: DataFrame, column: str, out: str) -> DataFrame:
    """Sparse 0/1 vector with a slot per category, for columns with too many values for a column each; null is all zeros."""
    known = category_table(df, column).count()
    encoder = OneHotEncoder(inputCol="_index", outputCol=out, dropLast=True)
    sized = encoder.fit(df.sparkSession.createDataFrame([(float(known),)], "_index double"))  # the last slot is for null
    return sized.transform(string_index(df, column, "_index")).drop("_index")


def one_hot_columns(df: DataFrame, column: str, drop_first: bool = False) -> DataFrame:
    """One 0/1 column per category, ``<column>=<value>``; unknown and null are all zeros."""
    known = categories(df, column)[1 if drop_first else 0:]
    return df.withColumns({f"{column}={v}": F.col(column).eqNullSafe(F.lit(v)).cast("int") for v in known})


def engineer(df: DataFrame) -> DataFrame:
    """Every row-wise feature on cleaned subscribers, in one projection chain."""
    named = service_named_columns(df)
    return (add_charge_ratios(add_service_features(add_tenure_group(df, "category", "tenure_category")))
            .withColumns({
                "tenure_group": tenure_bin("tenure", "prepared"),
                "service_count": count_not_equal(named, S.NEGATIVE),
                "avg_monthly_charge": avg_monthly_charge(),
                "tenure_charge": tenure_charge(),
                "HasInternetService": has_internet(),
                "HasSecurityProtection": has_security(),
            }))


def prepare_table(df: DataFrame) -> DataFrame:
    """Load-validate-clean-feature chain as one lazy plan."""
    return engineer(clean_subscribers(df))

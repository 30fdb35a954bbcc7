"""Exploratory tables: counts, profiles, cross tables, distributions. The table behind each plot, not the plot."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.functions.scalars import safe_ratio, unit_draw
from stayline.operators.clean import non_numeric, numeric_columns, quantile_value, text_columns
from stayline.plans.ordered import exact_quantiles
from stayline.plans.small import join_groups, settle


def is_positive(target: str = S.TARGET) -> Column:
    return F.coalesce((F.col(target) == S.POSITIVE).cast("int"), F.lit(0))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), most frequent first; nulls are not counted."""
    return (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "value"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """(value, n, share) among non-null rows."""
    total = df.agg(F.count(column).alias("total"))
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / total.scalar()).orderBy(F.desc("n"), "value")


def _unpivot(row: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row with ``<measure>|<column>`` fields to one row per column."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{m}|{c}`").alias(m) for m in measures]) for c in columns])))


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles, maximum per numeric column.

    ``exact=False`` takes the quartiles from a sketch in the same single pass.
    """
    cols = list(columns or numeric_columns(df))
    x = {c: F.col(c).cast("double") for c in cols}
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if not exact:
        measures |= {n: (lambda c, p=p: F.percentile_approx(c, p)) for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))}
    row = df.agg(*[f(x[c]).alias(f"{m}|{c}") for c in cols for m, f in measures.items()])
    basic = _unpivot(row, cols, list(measures))
    if not exact:
        return basic.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    quart = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).select(
        "column", *[F.element_at("q", i + 1).alias(n) for i, n in enumerate(["q25", "q50", "q75"])])
    return join_groups(basic, settle(quart), ["column"], "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def _long_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value as text, n) of all columns in one pass; equal values are combined before the shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return (df.select(F.explode(pairs).alias("e")).select("e.*").where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count("*").alias("n")))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, unique, top value (ties to the smallest) and its frequency."""
    counts = _long_counts(df, columns)
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"), F.max("n").alias("freq"))


def describe_all(df: DataFrame) -> DataFrame:
    """Both descriptions in one table; measures that do not apply are null."""
    return describe_text(df, text_columns(df)).unionByName(
        describe_numeric(df, numeric_columns(df)), allowMissingColumns=True)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls, null_pct) from one aggregate over all columns."""
    row = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"nulls|{c}") for c in df.columns])
    long = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`nulls|{c}`").alias("nulls"), F.col("total")) for c in df.columns])))
    return long.select("column", "nulls", safe_ratio(F.col("nulls") * 100, "total").alias("null_pct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows. Only a 256-bit digest of a row is shuffled."""
    def plain(f: T.StructField) -> Column:
        c = F.col(f.name)
        return (c + F.lit(0.0)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c

    digest = F.sha2(F.to_json(F.struct(*[plain(f) for f in df.schema.fields]), {"ignoreNullFields": "false"}), 256)
    return (df.select(digest.alias("d")).groupBy("d").agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")))


def _first_values(counts: DataFrame, k: int) -> DataFrame:
    """The k smallest values per column; the rank filter is applied before the shuffle as well."""
    ranked = counts.withColumn("r", F.row_number().over(W.partitionBy("column").orderBy("value"))).where(F.col("r") <= k)
    return ranked.groupBy("column").agg(F.concat_ws(",", F.array_sort(F.collect_list("value"))).alias("first_values"))


def _types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                           "column string, dtype string")


def _column_facts(df: DataFrame, listed: int) -> DataFrame:
    """(column, dtype, non_null, nulls, total, n_unique, first_values) from one count of values per column."""
    counts = _long_counts(df, df.columns)
    facts = counts.groupBy("column").agg(F.count("*").alias("n_unique"), F.sum("n").alias("non_null"))
    total = df.agg(F.count("*").alias("total"))
    non_null = F.coalesce("non_null", F.lit(0))
    return (_types(df).join(facts, "column", "left").join(_first_values(counts, listed), "column", "left")
            .withColumn("total", total.scalar())
            .select("column", "dtype", non_null.alias("non_null"), (F.col("total") - non_null).alias("nulls"), "total",
                    F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "first_values"))


def column_report(df: DataFrame, listed: int = 10) -> DataFrame:
    """Type, nulls, distinct values, and the values themselves where fewer than ``listed``."""
    return _column_facts(df, listed).select(
        "column", "dtype", "nulls", "n_unique", F.when(F.col("n_unique") < listed, F.col("first_values")).alias("distinct_values"))


def profile(df: DataFrame, samples: int = 3) -> DataFrame:
    """Type, non-null count, null percentage, distinct values and the first few of them per column."""
    return _column_facts(df, samples).select(
        "column", "dtype", "non_null", safe_ratio(F.col("nulls") * 100, "total").alias("null_pct"), "n_unique",
        F.col("first_values").alias("samples"))


def binary_check(df: DataFrame, columns: Sequence[str] = tuple(S.BINARY_COLUMNS)) -> DataFrame:
    """Whether a column holds nothing but Yes and No; a null breaks the rule."""
    row = df.agg(*[F.bool_and(F.coalesce(F.col(c).isin(S.POSITIVE, S.NEGATIVE), F.lit(False))).alias(f"is_binary|{c}")
                   for c in columns])
    return _unpivot(row, columns, ["is_binary"])


def non_numeric_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(non_numeric(column)).alias("non_numeric"))


def crosstab(df: DataFrame, a: str, b: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts of b's values per value of a, rows with a null left out.

    With ``values`` a column for each of them, else one row (a, b, n) per pair that occurs, however many there are.
    """
    present = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    if values is None:
        return present.groupBy(a, b).agg(F.count("*").alias("n"))
    return present.groupBy(a).agg(*[F.count_if(F.col(b) == v).alias(v) for v in values])


def crosstab_pct(df: DataFrame, a: str, b: str, values: Sequence[str] | None = None) -> DataFrame:
    """The same in percent of the row; without ``values`` as (a, b, pct)."""
    counts = crosstab(df, a, b, values)
    if values is None:
        share = F.col("n") * 100.0 / F.sum("n").over(W.partitionBy(a))  # one row per pair
        return counts.select(a, b, share.alias("pct"))
    wanted = counts.columns[1:]
    total = sum((F.col(f"`{v}`") for v in wanted), F.lit(0))
    return counts.select(a, *[(F.try_divide(F.col(f"`{v}`") * 100.0, total)).alias(v) for v in wanted])


def churn_rate_by_group(df: DataFrame, groups: Sequence[str], target: str = S.TARGET) -> DataFrame:
    """Subscribers, churners and churn percentage per group."""
    return df.groupBy(*groups).agg(F.count("*").alias("subscribers"), F.sum(is_positive(target)).alias("churners"),
                                   (F.avg(is_positive(target)) * 100).alias("churn_rate"))


def segment_profile(df: DataFrame, segment: str, target: str = S.TARGET) -> DataFrame:
    return df.groupBy(segment).agg(
        F.count("*").alias("subscribers"), F.avg("tenure").alias("mean_tenure"),
        F.avg("MonthlyCharges").alias("mean_charge"), (F.avg(is_positive(target)) * 100).alias("churn_rate"))


def rule_segment() -> Column:
    """First matching rule wins: High, Medium, Low, else Other."""
    contract, tenure = F.col("Contract"), F.col("tenure")
    return (F.when((contract == S.CONTRACTS[0]) & (tenure < 12) & (F.col("MonthlyCharges") > 70), "High")
            .when((contract == S.CONTRACTS[1]) | tenure.between(12, 24), "Medium")
            .when((contract == S.CONTRACTS[2]) & (tenure > 24), "Low").otherwise("Other"))


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson matrix in long form, each pair over its own non-null rows, in one aggregate."""
    cols = list(columns or numeric_columns(df))
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r|{i}")
                   for i, (a, b) in enumerate(pairs)])
    cells = [(a, b, i) for i, (a, b) in enumerate(pairs)] + [(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`r|{i}`").alias("r"))
        for a, b, i in cells])))


def box_stats(df: DataFrame, column: str, by: Sequence[str], factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (outermost values inside the fences) and outlier counts per group."""
    quart = settle(exact_quantiles(df, [column], [0.25, 0.5, 0.75], by).select(
        *by, *[F.element_at("q", i + 1).alias(n) for i, n in enumerate(["q25", "q50", "q75"])]))
    x = F.col(column).cast("double")
    reach = (F.col("q75") - F.col("q25")) * factor
    inside = (x >= F.col("q25") - reach) & (x <= F.col("q75") + reach)
    rows = df.select(*by, column).where(x.isNotNull() & ~F.isnan(x))
    return join_groups(rows, quart, by).groupBy(*by, "q25", "q50", "q75").agg(
        F.count("*").alias("n"), F.min(F.when(inside, x)).alias("low_whisker"),
        F.max(F.when(inside, x)).alias("high_whisker"), F.count_if(~inside).alias("outliers"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones included; the last bin is closed."""
    x = F.col(column).cast("double")
    valid = df.where(x.isNotNull() & ~F.isnan(x))
    ends = valid.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    schema = "bin int, bin_from double, bin_to double, n long"
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], schema)
    lo, hi = ends["lo"], ends["hi"]
    width = (hi - lo) / bins or 1.0
    counts = valid.groupBy(F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int").alias("bin")) \
        .agg(F.count("*").alias("n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), (F.lit(lo) + F.col("id") * F.lit(width)).alias("bin_from"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width)).alias("bin_to"))
    return edges.join(counts, "bin", "left").select("bin", "bin_from", "bin_to", F.coalesce("n", F.lit(0)).alias("n"))


def imbalance_ratio(df: DataFrame, column: str) -> DataFrame:
    """Smallest class over largest class."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.min("n").alias("smallest"), F.max("n").alias("largest"),
                      F.try_divide(F.min("n"), F.max("n")).alias("ratio"))


def headline_kpis(df: DataFrame, p: float = 0.8) -> DataFrame:
    """Churn percentage overall and above the p-quantile of charges, mean tenure, mean charge."""
    threshold = quantile_value(df, "MonthlyCharges", p)
    high = F.col("MonthlyCharges") > F.lit(threshold).cast("double")
    return df.agg((F.avg(is_positive()) * 100).alias("churn_rate"),
                  (F.avg(F.when(high, is_positive())) * 100).alias("high_value_churn_rate"),
                  F.avg("tenure").alias("mean_tenure"), F.avg("MonthlyCharges").alias("mean_charge"))


def scatter_sample(df: DataFrame, columns: Sequence[str], hue: str, fraction: float, seed: int = S.SEED,
                   key: str = S.KEY) -> DataFrame:
    """Points for a plot. Which rows are drawn follows from key and seed, not from how the table is split."""
    return df.where(unit_draw(key, seed) < fraction).select(*columns, hue)

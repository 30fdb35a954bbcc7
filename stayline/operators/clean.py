"""Cleaning, imputation and validation of subscriber tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline import schema as S
from stayline.functions.scalars import as_col, to_number
from stayline.plans.ordered import exact_quantiles


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text to double; what is not a number becomes null."""
    return df.withColumns({c: to_number(c) for c in columns})


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in the subset, or in any column."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def encode_label(df: DataFrame, column: str = S.TARGET, out: str = "label") -> DataFrame:
    """Yes/No to 1/0. Anything else, null included, stays null so that it can be dropped knowingly."""
    return df.withColumn(out, F.when(F.col(column) == S.POSITIVE, 1).when(F.col(column) == S.NEGATIVE, 0))


def fill_constant(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    return df.fillna(dict(values))


def fill_if_all_null(df: DataFrame, column: str, value: float = 0.0) -> DataFrame:
    """Fill only where the whole column is null."""
    present = df.agg(F.count(column).alias("n"))
    return df.withColumn(column, F.when(present.scalar() == 0, F.lit(value)).otherwise(F.col(column)))


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians, found once and put in as literals."""
    medians = {r["column"]: r["q"][0] for r in exact_quantiles(df, columns, [0.5]).collect()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double"))
                           for c in columns})


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c]).cast("double")) for c in columns})


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column, ties to the smallest. Values are counted across tasks, not in one map."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in columns])).alias("e")).select("e.*").where("value is not null")
    best = (long.groupBy("column", "value").agg(F.count("*").alias("n")).groupBy("column")
            .agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")))
    return {r["column"]: r["mode"] for r in best.collect()}


def impute_mode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = modes(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found.get(c)).cast(df.schema[c].dataType)) for c in columns})


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema: absent ones as typed nulls, others cast. No job runs."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def field(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        c = F.col(f.name)
        return c if have[f.name] == f.dataType else c.cast("string").try_cast(f.dataType).alias(f.name)

    return df.select(*[field(f) for f in schema.fields])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def validate_rows(df: DataFrame, required: Sequence[str], numeric: Sequence[str], out: str = "error") -> DataFrame:
    """Raise on absent columns; name the non-numeric fields of each row in ``error`` (null when the row is good)."""
    require_columns(df, [*required, *numeric])
    problems = F.filter(F.array(*[
        F.when(to_number(c).isNull(), F.lit(f"{c} is not numeric")) for c in numeric]), lambda m: m.isNotNull())
    return df.withColumn(out, F.when(F.size(problems) > 0, F.concat_ws("; ", problems)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def quantile_value(df: DataFrame, column: str, p: float) -> float | None:
    row = exact_quantiles(df, [column], [p]).select(F.element_at("q", 1).alias("v")).first()
    return row["v"] if row else None


def above_quantile(df: DataFrame, column: str, p: float = 0.8) -> DataFrame:
    """Rows strictly above the exact quantile; the threshold reaches the scan as a literal."""
    threshold = quantile_value(df, column, p)
    return df.where(F.col(column) > F.lit(threshold).cast("double"))


def cast_flag(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("boolean") for c in columns})


def non_numeric(c: Column | str) -> Column:
    """Text that is there but is no number."""
    return as_col(c).isNotNull() & to_number(c).isNull()


def clean_subscribers(df: DataFrame) -> DataFrame:
    """Numbers from text, rows without total charges out, 0/1 label; the key is kept."""
    coerced = coerce_numeric(df, ["TotalCharges"])
    kept = coerced.dropna(subset=["TotalCharges"])
    return encode_label(kept).dropna(subset=["label"])


def any_of(columns: Sequence[str], value: str) -> Column:
    return reduce(lambda a, b: a | b, (F.col(c).eqNullSafe(F.lit(value)) for c in columns))

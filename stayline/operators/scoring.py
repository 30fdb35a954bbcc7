"""Batch scoring: labels, confidence, risk and the outgoing envelope. One row scores the same way as a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.binning import risk_level
from stayline.functions.scalars import iso_timestamp


@dataclass(frozen=True)
class Scorecard:
    """A fixed logistic scorecard: numeric coefficients and bonuses for categories."""

    intercept: float
    coefficients: Mapping[str, float]
    bonuses: Mapping[tuple[str, str], float] = field(default_factory=dict)

    def margin(self) -> Column:
        total = F.lit(self.intercept)
        for name, weight in self.coefficients.items():
            total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * weight
        for (name, value), weight in self.bonuses.items():
            total = total + F.when(F.col(name) == value, weight).otherwise(0.0)
        return total

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return df.withColumn(out, 1.0 / (1.0 + F.exp(-self.margin())))


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def confidence(p: Column | str) -> Column:
    """The larger of the two class probabilities."""
    x = F.col(p) if isinstance(p, str) else p
    return F.array_max(F.array(1 - x, x))


def predictions(df: DataFrame, score: str = "score", key: str = S.KEY, threshold: float = 0.5,
                extra: Sequence[str] = ()) -> DataFrame:
    """Key, probability, Yes/No, label text, risk level and confidence, plus passed-through columns."""
    p = F.col(score)
    hit = p >= threshold
    return df.select(
        key, p.alias("churn_probability"),
        F.when(hit, S.POSITIVE).when(p.isNotNull(), S.NEGATIVE).alias("prediction"),
        F.when(hit, "Churn").when(p.isNotNull(), "No Churn").alias("prediction_label"),
        risk_level(p).alias("risk_level"), confidence(p).alias("confidence_score"), *extra)


def envelope(df: DataFrame, event_ts: Column, processed_ts: Column, key: str = S.KEY, unlisted: Column | None = None) -> DataFrame:
    """(key, value) messages of scored rows; the processing time is given by the caller, ``unlisted`` is carried along."""
    fields = F.struct(
        F.col(key).alias("customerID"), "churn_probability", "prediction", "confidence_score",
        event_ts.alias("event_ts"), iso_timestamp(processed_ts).alias("processed_ts"),
        *([] if unlisted is None else [unlisted.alias("unlisted")]))
    return df.select(F.col(key).alias("key"), F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def vote_soft(df: DataFrame, columns: list[str], out: str = "score") -> DataFrame:
    """Mean probability of several models."""
    return df.withColumn(out, sum((F.col(c) for c in columns), F.lit(0.0)) / len(columns))


def vote_hard(df: DataFrame, columns: list[str], out: str = "prediction", threshold: float = 0.5) -> DataFrame:
    """Majority of the models' predictions; a draw goes to class 0."""
    votes = sum(((F.col(c) >= threshold).cast("int") for c in columns), F.lit(0))
    return df.withColumn(out, (votes * 2 > len(columns)).cast("int"))

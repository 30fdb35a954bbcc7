"""What drives a score: named importances, exact linear contributions, permutation importance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.operators.metrics import roc_auc
from stayline.operators.scoring import positive_probability
from stayline.plans.durable import cut_lineage
from stayline.plans.ordered import hash_rank


def linear_contributions(df: DataFrame, key: str, coefficients: Mapping[str, float]) -> DataFrame:
    """coefficient * (value - mean) for every row and feature; sums to the margin's distance from the mean margin."""
    names = list(coefficients)
    means = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    parts = [F.struct(F.lit(c).alias("feature"),
                      ((F.col(c) - F.lit(means[c]).cast("double")) * F.lit(float(coefficients[c]))).alias("contribution"))
             for c in names]
    return df.select(key, F.explode(F.array(*parts)).alias("p")).select(key, "p.*")


def feature_names(prepared: DataFrame) -> list[str]:
    """Names of the feature slots from the attribute metadata; scalers drop it, so the assembled vector is asked first."""
    vector = "assembled" if "assembled" in prepared.columns else "features"
    attrs = prepared.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a.get("name", str(a["idx"]))) for group in attrs.values() for a in group)
    return [name for _, name in slots]


def importances(df: DataFrame, model: Transformer, names: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model, or (feature, coefficient) size of a linear one; one row per slot."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    vector = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(names[i] if i < len(names) else f"f{i}", float(v), abs(float(v))) for i, v in enumerate(vector.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double, importance double")


def top_features(df: DataFrame, model: Transformer, names: Sequence[str], n: int = 10) -> DataFrame:
    return importances(df, model, names).orderBy(F.desc("importance"), "feature").limit(n)


def top_contributions(contributions: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The n strongest contributions of each row."""
    order = W.partitionBy(key).orderBy(F.desc(F.abs("contribution")), "feature")
    return contributions.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def shuffle_column(df: DataFrame, key: str, column: str, seed: int = 42) -> DataFrame:
    """Values of one column dealt out to other rows.

    Row i in hash order takes the value of the row that is i-th in another hash order: an equi-join on the rank.
    """
    rows = hash_rank(df, key, (), seed, "_place")
    dealt = hash_rank(df.select(key, column), key, (), seed + 1, "_place").select("_place", F.col(column).alias("_dealt"))
    return rows.join(dealt, "_place").withColumn(column, F.col("_dealt")).drop("_place", "_dealt").select(*df.columns)


def permutation_importance(df: DataFrame, model: Transformer, key: str, columns: Sequence[str], label: str = "label",
                           seed: int = 42) -> DataFrame:
    """(feature, base_auc, shuffled_auc, importance): how much the exact ROC AUC falls when a column is shuffled."""
    rows = cut_lineage(df)  # read once per column

    def scored(name: str, variant: DataFrame) -> DataFrame:
        return model.transform(variant).select(F.lit(name).alias("feature"), label, positive_probability().alias("score"))

    parts = scored("", rows)
    for column in columns:
        parts = parts.unionByName(scored(column, shuffle_column(rows, key, column, seed)))
    areas = {r["feature"]: r["roc_auc"] for r in roc_auc(cut_lineage(parts), ["feature"], label).collect()}
    base = areas[""]
    return df.sparkSession.createDataFrame([(c, base, areas[c], base - areas[c]) for c in columns],
                                           "feature string, base_auc double, shuffled_auc double, importance double")

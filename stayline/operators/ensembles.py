"""Voting, stacking and blending of Spark ML classifiers.

Base models are chained as transformers, so their scores become columns of one table: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.operators.models import classifier, deal_out, fit_all, prepare, scores
from stayline.operators.sampling import folds_stratified, split_stratified, train_test
from stayline.operators.scoring import positive_probability, vote_hard, vote_soft
from stayline.plans.durable import cut_lineage


def add_scores(df: DataFrame, models: Mapping[str, Transformer]) -> DataFrame:
    """One ``score_<name>`` column per model."""
    for name, model in models.items():
        df = model.transform(df).withColumn(f"score_{name}", positive_probability()).drop(
            "rawPrediction", "probability", "prediction")
    return df


@dataclass
class Ensemble:
    """Fitted preparation, base models and either a vote or a meta model."""

    preparation: PipelineModel
    bases: dict[str, Transformer]
    meta: Transformer | None = None
    voting: str = "soft"

    def transform(self, df: DataFrame) -> DataFrame:
        """(key, label, score, prediction) for every row."""
        rows = add_scores(self.preparation.transform(df).select(S.KEY, "label", "features"), self.bases)
        columns = [f"score_{b}" for b in self.bases]
        if self.meta is not None:
            return scores(self.meta.transform(_meta_vector(rows.drop("features"), columns)))
        voted = vote_soft(rows, columns)
        if self.voting == "hard":
            return vote_hard(voted, columns).select(S.KEY, "label", "score", "prediction")
        return voted.select(S.KEY, "label", "score", (F.col("score") >= 0.5).cast("int").alias("prediction"))


def _meta_vector(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df)


def voting(train: DataFrame, estimators: Mapping[str, Estimator], kind: str = "soft") -> Ensemble:
    """Mean probability (soft) or majority (hard)."""
    if kind not in ("soft", "hard"):
        raise ValueError(f"unknown voting {kind!r}: use soft or hard")
    prepared = prepare(train)
    models = fit_all(prepared.train, estimators)
    prepared.release()
    return Ensemble(prepared.model, models, voting=kind)


def stacking(train: DataFrame, estimators: Mapping[str, Estimator], meta: Estimator | None = None,
             folds: int = S.CV_FOLDS, seed: int = S.SEED) -> Ensemble:
    """The meta model learns from out-of-fold scores; bases are refitted on everything."""
    prepared = prepare(train)
    marked = cut_lineage(folds_stratified(prepared.train, S.KEY, ["label"], folds, seed))
    marked = deal_out(marked, S.KEY).persist(StorageLevel.MEMORY_AND_DISK)
    held_out = None
    for fold in range(folds):
        models = fit_all(marked.where(F.col("fold") != fold).drop("fold"), estimators)
        part = add_scores(marked.where(F.col("fold") == fold).drop("fold"), models).drop("features")
        held_out = part if held_out is None else held_out.unionByName(part)
    meta_model = (meta or classifier("lr")).fit(_meta_vector(held_out, [f"score_{n}" for n in estimators]))
    bases = fit_all(prepared.train, estimators)
    marked.unpersist()
    prepared.release()
    return Ensemble(prepared.model, bases, meta_model)


def blending(train: DataFrame, estimators: Mapping[str, Estimator], meta: Estimator | None = None, share: float = 0.3,
             seed: int = S.SEED) -> Ensemble:
    """Bases learn from the larger part, the meta model from their scores on the held-out part; nothing is refitted."""
    fitted_on, held = train_test(split_stratified(train, S.KEY, ["label"], share, seed))
    prepared = prepare(fitted_on)
    bases = fit_all(prepared.train, estimators)
    prepared.release()
    rows = add_scores(prepared.model.transform(held).select(S.KEY, "label", "features"), bases).drop("features")
    meta_model = (meta or classifier("lr")).fit(_meta_vector(rows, [f"score_{n}" for n in estimators]))
    return Ensemble(prepared.model, bases, meta_model)

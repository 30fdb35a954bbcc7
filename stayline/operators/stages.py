"""Preprocessing as Spark ML stages that can be fitted, saved and loaded inside an ``ml.Pipeline``.

Fitted values are small (one entry per column or class) and are kept as JSON in a parameter, so they are written
with the stage's metadata and enter the plan as literals.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.base import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasOutputCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.binning import cut
from stayline.functions.scalars import clip
from stayline.operators.clean import clean_subscribers, coerce_numeric, modes
from stayline.operators.features import engineer, iqr_bounds
from stayline.plans.ordered import exact_quantiles


class _Fitted(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Base of models whose state is a JSON dictionary."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self, values: dict | None = None):
        super().__init__()
        if values is not None:
            self._set(state=json.dumps(values))

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class Cut(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Interval labels; see ``functions.binning.cut``."""

    edges = Param(Params._dummy(), "edges", "interval edges", TypeConverters.toListFloat)
    labels = Param(Params._dummy(), "labels", "interval labels", TypeConverters.toListString)
    right = Param(Params._dummy(), "right", "closed on the right", TypeConverters.toBoolean)
    includeLowest = Param(Params._dummy(), "includeLowest", "lowest edge belongs to the first bin", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, edges: Sequence[float] | None = None,
                 labels: Sequence[str] | None = None, right: bool = True, includeLowest: bool = False):
        super().__init__()
        self._setDefault(right=True, includeLowest=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), cut(
            self.getInputCol(), self.getOrDefault(self.edges), self.getOrDefault(self.labels),
            self.getOrDefault(self.right), self.getOrDefault(self.includeLowest)))


class SubscriberFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cleaning and row-wise features. Training drops rows without total charges, scoring keeps every row."""

    dropIncomplete = Param(Params._dummy(), "dropIncomplete", "drop rows that cannot be trained on", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, dropIncomplete: bool = False):
        super().__init__()
        self._setDefault(dropIncomplete=False)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.getOrDefault(self.dropIncomplete):
            return engineer(clean_subscribers(dataset))
        return engineer(coerce_numeric(dataset, S.NUMERIC_FEATURES))


class ColumnImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fill nulls with the training mean, exact median or mode; works in place, on text columns too (mode)."""

    strategy = Param(Params._dummy(), "strategy", "mean, median or mode", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, strategy: str = "median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ColumnImputerModel:
        cols, strategy = self.getInputCols(), self.getOrDefault(self.strategy)
        if strategy == "mean":
            found = dataset.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
        elif strategy == "median":
            found = {r["column"]: r["q"][0] for r in exact_quantiles(dataset, cols, [0.5]).collect()}
        elif strategy == "mode":
            found = modes(dataset, cols)
        else:
            raise ValueError(f"unknown strategy {strategy!r}: use mean, median or mode")
        return self._copyValues(ColumnImputerModel({c: found.get(c) for c in cols}))


class ColumnImputerModel(_Fitted, HasInputCols):
    strategy = Param(Params._dummy(), "strategy", "mean, median or mode", TypeConverters.toString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def filled(c: str, v: object):
            kind = dataset.schema[c].dataType if isinstance(v, str) or v is None else "double"
            return F.coalesce(F.col(c).cast(kind), F.lit(v).cast(kind))

        return dataset.withColumns({c: filled(c, v) for c, v in self.values.items()})


class IqrClipper(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Clip to the interquartile fences of the training data."""

    factor = Param(Params._dummy(), "factor", "fence distance in interquartile ranges", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, factor: float = 1.5):
        super().__init__()
        self._setDefault(factor=1.5)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> IqrClipperModel:
        return self._copyValues(IqrClipperModel(iqr_bounds(dataset, self.getInputCols(), self.getOrDefault(self.factor))))


class IqrClipperModel(_Fitted, HasInputCols):
    factor = Param(Params._dummy(), "factor", "fence distance in interquartile ranges", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in self.values.items()})


class BalancedWeights(Estimator, HasLabelCol, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the weight n / (classes * n_class) of the row's class."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", weightCol: str = "weight"):
        super().__init__()
        self._setDefault(labelCol="label")
        self._set(labelCol=labelCol, weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> BalancedWeightsModel:
        label = F.col(self.getLabelCol()).cast("double")
        sizes = {str(r[0]): r[1] for r in dataset.where(label.isNotNull()).groupBy(label).count().collect()}
        total = sum(sizes.values())
        return self._copyValues(BalancedWeightsModel({g: total / (len(sizes) * n) for g, n in sizes.items()}))


class BalancedWeightsModel(_Fitted, HasLabelCol, HasWeightCol):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.getLabelCol() not in dataset.columns:
            return dataset
        label = F.col(self.getLabelCol()).cast("double")
        weight = F.lit(None).cast("double")
        for g, w in self.values.items():
            weight = F.when(label == float(g), w).otherwise(weight)
        return dataset.withColumn(self.getWeightCol(), weight)

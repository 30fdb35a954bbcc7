"""Fitted values per group, however many groups: kept as a table, written and read as Parquet, applied by a join.

Few groups are broadcast; many are joined through a shuffle, whose hot groups adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.scalars import order_key
from stayline.plans.durable import cut_lineage
from stayline.plans.ordered import HASH_DIGITS
from stayline.plans.small import join_groups, settle


# --- models whose state is a table ---------------------------------------------------------------------------------

class TableWriter(MLWriter):
    def __init__(self, instance: TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")


class TableReader(MLReader):
    def __init__(self, kind: type[TableModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.sparkSession.read.parquet(f"{path}/table"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class TableModel(Model, MLWritable, MLReadable):
    """Base of models with one row of fitted values per group."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self.table = table

    def write(self) -> TableWriter:
        return TableWriter(self)

    @classmethod
    def read(cls) -> TableReader:
        return TableReader(cls)


# --- deviation from the group's mean -------------------------------------------------------------------------------

class GroupMeanDeviation(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Value minus the training mean of its group; unseen groups, and rows without a group, give null."""

    groupCol = Param(Params._dummy(), "groupCol", "grouping column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, groupCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> GroupMeanDeviationModel:
        group = F.col(self.getOrDefault(self.groupCol))
        means = dataset.where(group.isNotNull()).groupBy(group.cast("string").alias("group")).agg(F.avg(self.getInputCol()).alias("mean"))
        return self._copyValues(GroupMeanDeviationModel(cut_lineage(means)))


class GroupMeanDeviationModel(TableModel, HasInputCol, HasOutputCol):
    groupCol = Param(Params._dummy(), "groupCol", "grouping column", TypeConverters.toString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = dataset.withColumn("_group", F.col(self.getOrDefault(self.groupCol)).cast("string"))
        means = self.table.select(F.col("group").alias("_group"), F.col("mean").alias("_mean"))
        found = join_groups(rows, settle(means), ["_group"], "left")
        return found.withColumn(self.getOutputCol(), F.col(self.getInputCol()) - F.col("_mean")).drop("_group", "_mean")


# --- target statistics ---------------------------------------------------------------------------------------------

def _long(df: DataFrame, columns: Sequence[str], *others: Column) -> DataFrame:
    """A row per row and column: (others..., column, category)."""
    return df.select(*others, F.explode(F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("category"))
                                                  for i, c in enumerate(columns)])).alias("_e")).select("*", "_e.*").drop("_e")


def smoothed(sums: Column, counts: Column, prior: Column | float, weight: float) -> Column:
    prior = prior if isinstance(prior, Column) else F.lit(float(prior))
    return (F.coalesce(sums, F.lit(0.0)) + prior * F.lit(float(weight))) / (F.coalesce(counts, F.lit(0)) + F.lit(float(weight)))


def label_mean(df: DataFrame, label: str) -> float:
    return float(df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)


def ordered_target_encode(df: DataFrame, key: str, columns: Sequence[str], label: str = "label", prior: float | None = None,
                          weight: float = 1.0, seed: int = S.SEED, suffix: str = "_target") -> DataFrame:
    """Add ``<column>_target``: (label sum + weight * prior) / (number + weight) over the rows of the same category that
    stand before the row in hash order, so no row's label enters its own value.

    Rows are cut into (category, hash bucket) blocks: block totals give the offset of each block, and only rows inside a
    block are ordered, so a category that holds most rows is spread over tens of thousands of blocks. All columns go
    through one pass, on narrow rows.

    The prior is the mean label unless given. Rows with one key share their value and do not see each other; a null
    category is one of its own; a null label counts for nobody, its row is encoded all the same; a row without key has no
    place in the order, counts for nobody and gets the prior.
    """
    prior = label_mean(df, label) if prior is None else prior
    text = F.col(key).cast("string")
    y = F.col(label).cast("double")
    rows = (_long(df.where(text.isNotNull()), columns, text.alias("_id"), order_key(text, seed).alias("_k"), y.alias("_y"))
            .groupBy("column", "category", "_k", "_id").agg(F.sum("_y").alias("_sum"), F.count("_y").alias("_n"))
            .withColumn("_b", F.substring("_k", 1, HASH_DIGITS)))
    group = ["column", "category", "_b"]
    earlier = W.partitionBy("column", "category").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy(*group).agg(F.sum("_sum").alias("_bs"), F.sum("_n").alias("_bn")).select(
        *group, F.coalesce(F.sum("_bs").over(earlier), F.lit(0.0)).alias("_os"), F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_on"))
    inside = W.partitionBy(*group).orderBy("_k", "_id").rowsBetween(W.unboundedPreceding, -1)
    placed = join_groups(rows, blocks, group).select(
        "_id", "column", "category", smoothed(F.col("_os") + F.coalesce(F.sum("_sum").over(inside), F.lit(0.0)),
                                              F.col("_on") + F.coalesce(F.sum("_n").over(inside), F.lit(0)), prior, weight).alias("_v"))
    # rows with one key may differ in their categories, so these are part of what is joined on
    kept = placed.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct(
        F.concat_ws(":", "column", F.coalesce(F.concat(F.lit("="), "category"), F.lit(""))), "_v"))).alias("_values"))
    found = df.withColumn("_text", text).join(kept.withColumnRenamed("_id", "_of"), F.col("_text") == F.col("_of"), "left")
    place = [F.concat(F.lit(f"{i}:"), F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))) for i, c in enumerate(columns)]
    return found.select(*df.columns, *[
        F.coalesce(F.try_element_at("_values", p), F.lit(float(prior))).alias(c + suffix) for c, p in zip(columns, place)])


class TargetEncoder(Estimator, HasInputCols, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Category means of the label for rows that come later; ``encode_training`` gives the training rows their ordered
    values, with the same prior and weight. Unseen categories get the prior."""

    weight = Param(Params._dummy(), "weight", "rows that the prior stands for", TypeConverters.toFloat)
    suffix = Param(Params._dummy(), "suffix", "of the added columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, labelCol: str = "label", weight: float = 1.0, suffix: str = "_target"):
        super().__init__()
        self._setDefault(labelCol="label", weight=1.0, suffix="_target")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> TargetEncoderModel:
        label = self.getLabelCol()
        long = _long(dataset, self.getInputCols(), F.col(label).cast("double").alias("_y"))
        sums = long.groupBy("column", "category").agg(F.sum("_y").alias("sum"), F.count("_y").alias("n"))
        model = self._copyValues(TargetEncoderModel(cut_lineage(sums)))
        return model._set(prior=label_mean(dataset, label))

    def encode_training(self, dataset: DataFrame, key: str, seed: int = S.SEED) -> DataFrame:
        return ordered_target_encode(dataset, key, self.getInputCols(), self.getLabelCol(), None, self.getOrDefault(self.weight),
                                     seed, self.getOrDefault(self.suffix))


class TargetEncoderModel(TableModel, HasInputCols, HasLabelCol):
    weight = Param(Params._dummy(), "weight", "rows that the prior stands for", TypeConverters.toFloat)
    suffix = Param(Params._dummy(), "suffix", "of the added columns", TypeConverters.toString)
    prior = Param(Params._dummy(), "prior", "mean label of the training rows", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset
        for i, c in enumerate(self.getInputCols()):
            own = self.table.where(F.col("column") == i).select(F.col("category").alias("_category"), F.col("sum").alias("_sum"), F.col("n").alias("_n"))
            found = join_groups(out.withColumn("_category", F.col(c).cast("string")), settle(own), ["_category"], "left")
            out = found.withColumn(c + self.getOrDefault(self.suffix), smoothed(
                F.col("_sum"), F.col("_n"), self.getOrDefault(self.prior), self.getOrDefault(self.weight))).drop("_category", "_sum", "_n")
        return out

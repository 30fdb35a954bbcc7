"""Reproducible splits, folds and class balancing. The order of rows is the hash of a unique key and a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.scalars import order_key, unit_draw
from stayline.plans.ordered import global_rank, hash_rank, mark_first
from stayline.plans.small import join_groups


def split_hash(df: DataFrame, key: str, share: float = S.TEST_SHARE, seed: int = S.SEED) -> DataFrame:
    """``is_test`` by hash threshold: no shuffle, and a row keeps its side when the table grows."""
    return df.withColumn("is_test", unit_draw(key, seed) < share)


def split_stratified(df: DataFrame, key: str, strata: Sequence[str], share: float = S.TEST_SHARE,
                     seed: int = S.SEED) -> DataFrame:
    """``is_test`` for exactly the rounded share of each stratum."""
    return mark_first(df, key, lambda n: F.floor(n * share + 0.5), strata, seed, "is_test")


def train_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(~F.col("is_test")).drop("is_test"), df.where("is_test").drop("is_test")


def folds_stratified(df: DataFrame, key: str, strata: Sequence[str], k: int = S.CV_FOLDS, seed: int = S.SEED,
                     out: str = "fold") -> DataFrame:
    """Fold numbers 0..k-1, dealt in hash order inside each stratum."""
    return hash_rank(df, key, strata, seed, out).withColumn(out, F.pmod(F.col(out) - 1, F.lit(k)).cast("int"))


def folds_plain(df: DataFrame, key: str, k: int = S.CV_FOLDS, seed: int = S.SEED, out: str = "fold") -> DataFrame:
    return folds_stratified(df, key, (), k, seed, out)


def folds_by(df: DataFrame, rule: Column, out: str = "fold") -> DataFrame:
    """Folds from any expression of the caller's."""
    return df.withColumn(out, rule.cast("int"))


def folds_time(df: DataFrame, order: Sequence[str], k: int = S.CV_FOLDS, out: str = "block") -> DataFrame:
    """Expanding folds over time: fold i (1..k) trains on blocks below i and tests on block i.

    Test blocks hold ``n // (k + 1)`` rows each, the first block takes the remainder.
    """
    ranked = global_rank(df, order, "_rank")
    n = ranked.agg(F.count("*").alias("n")).first()["n"]
    size = n // (k + 1)
    first = n - k * size
    block = F.when(F.col("_rank") < first, 0).otherwise(F.floor((F.col("_rank") - first) / max(size, 1)) + 1)
    return ranked.withColumn(out, block.cast("int")).drop("_rank")


def class_table(df: DataFrame, label: str) -> DataFrame:
    """(label, _n) rows per class. A null label is no class."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_n"))


def class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class on the driver, for work that goes class by class."""
    return {r[0]: r[1] for r in class_table(df, label).collect()}


def oversample(df: DataFrame, key: str, label: str, seed: int = S.SEED) -> DataFrame:
    """Repeat rows until every class is as large as the largest; which rows get the extra copy follows the hash.

    Column ``copy`` counts from 0; copy 0 is the original. Rows with a null label come back once.
    """
    sizes = class_table(df, label)
    target = sizes.agg(F.max("_n")).first()[0] or 0
    rest = mark_first(df, key, lambda n: F.pmod(F.lit(target), n), [label], seed, "_extra")
    wanted = F.floor(F.lit(target) / F.col("_n")).cast("int") + F.col("_extra").cast("int")
    copies = join_groups(rest, sizes, [label], "left").withColumn("_copies", F.coalesce(wanted, F.lit(1)))
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_extra", "_copies", "_n")


def undersample(df: DataFrame, key: str, label: str, seed: int = S.SEED) -> DataFrame:
    """Keep as many rows of each class as the smallest has. Rows with a null label come back unchanged."""
    target = class_table(df, label).agg(F.min("_n")).first()[0] or 0
    marked = mark_first(df, key, lambda n: F.lit(target), [label], seed, "_keep")
    return marked.where(F.col("_keep") | F.col(label).isNull()).drop("_keep")


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (classes * n_class); null for a null label, which counts nowhere."""
    sizes = class_table(df, label)
    every = sizes.agg(F.sum("_n").cast("double").alias("_total"), F.count("*").alias("_classes"))
    weights = join_groups(sizes, every, []).select(
        label, (F.col("_total") / (F.col("_n") * F.col("_classes"))).alias(out))
    return join_groups(df, weights, [label], "left")


def sample_n(df: DataFrame, key: str, n: int, seed: int = S.SEED) -> DataFrame:
    """n rows in hash order: top-n per task, then top-n of those."""
    return df.orderBy(order_key(key, seed), key).limit(n)

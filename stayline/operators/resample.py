"""Synthetic rows for small classes: interpolation between neighbours of the same class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline import schema as S
from stayline.functions.scalars import unit_draw
from stayline.operators.neighbors import nearest
from stayline.operators.sampling import class_sizes, oversample, undersample
from stayline.plans.durable import cut_lineage
from stayline.plans.ordered import mark_first

NEIGHBORS = 5


def _interpolate(rows: DataFrame, copies: Column, features: Sequence[str], seed: int) -> DataFrame:
    """(key, copy, features...) between a row and one of its neighbours; both draws follow from key, copy and seed."""
    many = (rows.withColumn("_copies", copies).where((F.col("_copies") > 0) & (F.size("near") > 0))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))))
    name = F.concat_ws("#", "key", F.col("copy").cast("string"))
    pick = F.floor(unit_draw(name, f"{seed}n") * F.size("near")).cast("int") + 1
    drawn = many.select("key", "copy", "x", F.element_at("near", pick)["point"].alias("to"),
                        unit_draw(name, f"{seed}g").alias("gap"))
    return drawn.select("key", "copy", *[
        (F.col("x")[i] + F.col("gap") * (F.col("to")[i] - F.col("x")[i])).alias(c) for i, c in enumerate(features)])


def _assemble(df: DataFrame, made: list[DataFrame], key: str, label: str, features: Sequence[str]) -> DataFrame:
    out = df.select(F.col(key).cast("string").alias(key), label, *[F.col(c).cast("double").alias(c) for c in features],
                    F.lit(False).alias("synthetic"))
    for part in made:
        out = out.unionByName(part)
    return out


def _finish(made: DataFrame, key: str, label: str, value: object, label_type: object, features: Sequence[str]) -> DataFrame:
    return made.select(F.concat_ws("#", "key", F.col("copy").cast("string")).alias(key),
                       F.lit(value).cast(label_type).alias(label), *features, F.lit(True).alias("synthetic"))


def smote(df: DataFrame, key: str, label: str, features: Sequence[str], k: int = NEIGHBORS, seed: int = S.SEED,
          leaf_rows: int = 4096) -> DataFrame:
    """Every class brought to the size of the largest with points between a row and one of its k class neighbours.

    The number of new points is spread evenly over the rows of a class; which rows get one more follows the hash.
    """
    sizes = class_sizes(df, label)
    target = max(sizes.values(), default=0)
    made = []
    for value, n in sizes.items():
        need = target - n
        if value is None or need <= 0:
            continue
        rows = df.where(F.col(label) == F.lit(value)).select(key, *features)
        near = cut_lineage(nearest(rows, rows, key, features, k, leaf_rows))  # ranked first, then interpolated
        each, rest = divmod(need, n)
        marked = mark_first(near, "key", lambda _, rest=rest: F.lit(rest), (), seed, "_more") if rest else \
            near.withColumn("_more", F.lit(False))
        points = _interpolate(marked, F.lit(each) + F.col("_more").cast("int"), features, seed)
        made.append(_finish(points, key, label, value, df.schema[label].dataType, features))
    return _assemble(df, made, key, label, features)


def adasyn(df: DataFrame, key: str, label: str, features: Sequence[str], k: int = NEIGHBORS, seed: int = S.SEED,
           leaf_rows: int = 4096) -> DataFrame:
    """As SMOTE, but a row gets new points in proportion to how many of its k neighbours belong to other classes."""
    sizes = class_sizes(df, label)
    target = max(sizes.values(), default=0)
    labels = df.select(F.col(key).cast("string").alias("neighbor"), F.col(label).alias("_other"))
    made = []
    for value, n in sizes.items():
        need = target - n
        if value is None or need <= 0:
            continue
        rows = df.where(F.col(label) == F.lit(value)).select(key, *features)
        around = nearest(rows, df.select(key, *features), key, features, k, leaf_rows)
        foreign = cut_lineage(
            around.select("key", F.explode("near").alias("n")).select("key", "n.neighbor").join(labels, "neighbor")
            .groupBy("key").agg(F.count_if(F.col("_other") != F.lit(value)).alias("foreign")))  # summed, then joined
        total = foreign.agg(F.sum("foreign").alias("t")).first()["t"]
        if not total:
            raise ValueError(f"no row of class {value!r} has a neighbour of another class: use smote")
        near = nearest(rows, rows, key, features, k, leaf_rows).join(foreign, "key")
        points = _interpolate(near, F.rint(F.col("foreign") * F.lit(float(need)) / F.lit(float(total))).cast("int"),
                              features, seed)
        made.append(_finish(points, key, label, value, df.schema[label].dataType, features))
    return _assemble(df, made, key, label, features)


METHODS = ("smote", "adasyn", "oversample", "undersample")


def balance(table: DataFrame, method: str, key: str = S.KEY, label: str = "label", vector: str = "features",
            seed: int = S.SEED) -> DataFrame:
    """Balance a table of feature vectors by one of ``METHODS``: (key, label, vector) comes back."""
    if method == "oversample":
        out = oversample(table, key, label, seed)
        return out.withColumn(key, F.when(F.col("copy") > 0, F.concat_ws("#", key, F.col("copy").cast("string")))
                              .otherwise(F.col(key).cast("string"))).select(key, label, vector)
    if method == "undersample":
        return undersample(table, key, label, seed).select(key, label, vector)
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}: use one of {', '.join(METHODS)}")
    size = table.select(F.array_size(vector_to_array(vector))).first()[0]
    slots = [f"_f{i}" for i in range(size)]
    values = vector_to_array(vector)
    wide = table.select(key, label, *[values[i].alias(c) for i, c in enumerate(slots)])
    made = (smote if method == "smote" else adasyn)(wide, key, label, slots, seed=seed)
    return made.select(key, label, array_to_vector(F.array(*slots)).alias(vector))

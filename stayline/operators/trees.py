"""Which features moved the score of a row: Shapley values of fitted trees, exact, for every row.

The value of a set of known features is the path-dependent expectation: at a split on an unknown feature both sides are
followed, weighted by how many training rows went there. Every leaf is turned into its path, with the splits on one
feature merged into one condition (an interval or a set of categories) and one share of training rows. For a row a leaf's
contribution follows from which conditions hold: a polynomial over the conditions is extended once per leaf and one
condition at a time is unwound from it. numpy does that for blocks of leaves and rows inside tasks, rows stay where they
are, and nothing is shuffled.

What is explained is the probability of class 1 for a decision tree or a random forest, and the margin (half the log odds)
for boosted trees. Contributions of a row sum to what is explained, less its expectation.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.plans.durable import work_path

PART_LEAVES = 50_000  # leaves that are sent to the workers together
CELLS = 1 << 20  # leaf conditions times rows worked on at once
BATCH_ROWS = 256


@dataclass
class Leaves:
    """Leaves with the same number of conditions; arrays are (leaf, condition)."""

    feature: np.ndarray
    low: np.ndarray  # a row passes if it is above low ...
    high: np.ndarray  # ... and not above high
    place: np.ndarray  # of the condition's categories in ``allowed``, or -1
    sizes: np.ndarray  # number of categories
    share: np.ndarray  # of training rows that pass
    value: np.ndarray  # per leaf
    allowed: np.ndarray


# ------------------------------------------------------------------------------------------------------- the model

def node_rows(spark: SparkSession, model: Transformer) -> DataFrame:
    """(tree, id, left, right, feature, split, categories, count, stats, prediction) of a fitted tree model, from its own files."""
    path = work_path(spark, "trees")
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data")
    rows = rows.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in rows.columns else rows.select(F.lit(0).alias("tree"), "*")
    return rows.select("tree", "id", F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
                       F.col("split.featureIndex").alias("feature"), F.col("split.leftCategoriesOrThreshold").alias("split"),
                       F.col("split.numCategories").alias("categories"), F.col("rawCount").cast("double").alias("count"),
                       F.col("impurityStats").alias("stats"), "prediction")


def _tree_weights(model: Transformer) -> list[float] | None:
    """Weights of boosted trees; None for trees that hold class counts."""
    if type(model).__name__.startswith("GBT"):
        return [float(w) for w in model.treeWeights]
    if getattr(model, "numClasses", 2) != 2:
        raise ValueError("only two classes are explained")
    return None


def leaf_parts(spark: SparkSession, model: Transformer, part_leaves: int = PART_LEAVES) -> tuple[list[list[Leaves]], float]:
    """The leaves of a model in parts of bounded size, and the expectation.

    A fitted model is held by the driver anyway; its nodes are read from there tree by tree.
    """
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    weights = _tree_weights(model)
    nodes: dict[int, dict[int, tuple]] = {}
    for r in node_rows(spark, model).collect():  # as many rows as the model has nodes
        nodes.setdefault(r["tree"], {})[r["id"]] = r
    parts, paths, base = [], [], 0.0
    for tree, by_id in sorted(nodes.items()):
        scale = 1.0 / len(nodes) if weights is None else weights[tree]
        for path, value in _paths(by_id, weights is None):
            paths.append((path, value * scale))
            base += value * scale * float(np.prod([c["share"] for c in path.values()]))
        if len(paths) >= part_leaves:
            parts.append(_grouped(paths))
            paths = []
    if paths:
        parts.append(_grouped(paths))
    return parts, base


def _paths(nodes: Mapping[int, tuple], counts: bool) -> Iterator[tuple[dict, float]]:
    """Conditions by feature, and the value, of every leaf of a tree."""
    def covered(node) -> float:
        return sum(node["stats"]) if counts else node["count"]

    def side(path: dict, node, left: bool) -> dict:
        feature, child = node["feature"], nodes[node["left"] if left else node["right"]]
        have = path.get(feature, {"low": None, "high": None, "allowed": None, "share": 1.0})
        have = {**have, "share": have["share"] * covered(child) / covered(node)}
        if node["categories"] >= 0:
            goes = np.zeros(node["categories"], bool)
            goes[np.array(node["split"], int)] = True
            goes = goes if left else ~goes
            have["allowed"] = goes if have["allowed"] is None else have["allowed"] & goes
        elif left:
            have["high"] = node["split"][0] if have["high"] is None else min(have["high"], node["split"][0])
        else:
            have["low"] = node["split"][0] if have["low"] is None else max(have["low"], node["split"][0])
        return {**path, feature: have}

    open_ = [(nodes[0], {})]
    while open_:
        node, path = open_.pop()
        if node["left"] < 0:
            yield path, (node["stats"][1] / sum(node["stats"]) if counts else node["prediction"])
        else:
            open_ += [(nodes[node["left"]], side(path, node, True)), (nodes[node["right"]], side(path, node, False))]


def _grouped(paths: list[tuple[dict, float]]) -> list[Leaves]:
    out = []
    for depth in sorted({len(p) for p, _ in paths} - {0}):
        own = [(p, v) for p, v in paths if len(p) == depth]
        conditions = [c for p, _ in own for c in p.values()]
        tables = [c["allowed"] for c in conditions if c["allowed"] is not None]
        sizes = np.array([0 if c["allowed"] is None else len(c["allowed"]) for c in conditions])
        shape = (len(own), depth)
        out.append(Leaves(
            np.array([f for p, _ in own for f in p]).reshape(shape),
            np.array([np.nan if c["low"] is None else c["low"] for c in conditions]).reshape(shape),
            np.array([np.nan if c["high"] is None else c["high"] for c in conditions]).reshape(shape),
            np.where(sizes > 0, np.cumsum(sizes) - sizes, -1).reshape(shape), sizes.reshape(shape),
            np.array([c["share"] for c in conditions]).reshape(shape), np.array([v for _, v in own]),
            np.concatenate(tables) if tables else np.zeros(1, bool)))
    return out


# ------------------------------------------------------------------------------------------------------- the values

def passes(leaves: Leaves, rows: np.ndarray) -> np.ndarray:
    """(leaf, condition, row): whether the row meets the condition. A value that is no number goes right, as in training."""
    x = rows.T[leaves.feature]
    with np.errstate(invalid="ignore"):
        inside = ((np.isnan(leaves.low)[..., None] | ~(x <= leaves.low[..., None]))
                  & (np.isnan(leaves.high)[..., None] | (x <= leaves.high[..., None])))
    sets = leaves.place >= 0
    if sets.any():
        code = np.nan_to_num(x[sets], nan=-1.0).astype(np.int64)
        size = leaves.sizes[sets][:, None]
        known = (code >= 0) & (code < size)
        inside[sets] = leaves.allowed[leaves.place[sets][:, None] + np.where(known, code, 0)] & known
    return inside


def shapley(leaves: Leaves, rows: np.ndarray, out: np.ndarray) -> None:
    """Add the contributions of the leaves to ``out`` (row, feature)."""
    depth = leaves.feature.shape[1]
    weight = np.array([factorial(k) * factorial(depth - 1 - k) / factorial(depth) for k in range(depth)])
    met = passes(leaves, rows).astype(np.float64)
    share = leaves.share[..., None]
    # coefficient k: the summed shares of the other conditions over all choices of k that are met
    poly = np.zeros((depth + 1, *met[:, 0].shape))
    poly[0] = 1.0
    for j in range(depth):
        poly[1:j + 2] = poly[1:j + 2] * share[:, j] + poly[:j + 1] * met[:, j]
        poly[0] *= share[:, j]
    parts = np.empty_like(met)
    for j in range(depth):
        own, z = met[:, j] > 0, share[:, j]
        rest, total = poly[depth].copy(), np.zeros_like(poly[0])
        for k in range(depth - 1, -1, -1):  # without condition j
            without = np.where(own, rest, poly[k] / z)
            total += weight[k] * without
            rest = poly[k] - z * rest
        parts[:, j] = (met[:, j] - z) * total * leaves.value[:, None]
    flat = leaves.feature.reshape(-1)
    order = np.argsort(flat, kind="stable")
    names, starts = np.unique(flat[order], return_index=True)
    out[:, names] += np.add.reduceat(parts.reshape(len(flat), -1)[order], starts, axis=0).T


def contributions_of(groups: Sequence[Leaves], rows: np.ndarray) -> np.ndarray:
    """(row, feature) contributions of a part of a model."""
    out = np.zeros_like(rows)
    for group in groups:
        step = max(1, CELLS // (group.feature.shape[1] * max(1, len(rows))))
        for i in range(0, len(group.value), step):
            cut = slice(i, i + step)
            shapley(Leaves(group.feature[cut], group.low[cut], group.high[cut], group.place[cut], group.sizes[cut],
                           group.share[cut], group.value[cut], group.allowed), rows, out)
    return out


# -------------------------------------------------------------------------------------------------------- in Spark

def explain_rows(df: DataFrame, model: Transformer, keep: Sequence[str], features: str = "features",
                 part_leaves: int = PART_LEAVES) -> DataFrame:
    """(keep..., base, contributions) of every row: one number per feature slot.

    Large models are sent in parts, each to a step of its own, so that no worker holds more than one part. A row whose
    vector is null has null contributions.
    """
    spark = df.sparkSession
    parts, base = leaf_parts(spark, model, part_leaves)
    vector = F.when(F.col(features).isNotNull(), vector_to_array(F.col(features)))
    out = df.select(*keep, vector.alias("_x"), F.transform(vector, lambda _: F.lit(0.0)).alias("contributions"))
    for part in parts:
        out = _add_part(out, spark.sparkContext.broadcast(part))
    return out.select(*keep, F.lit(base).alias("base"), "contributions")


def _add_part(df: DataFrame, part) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in (batch.slice(i, BATCH_ROWS) for i in range(0, batch.num_rows, BATCH_ROWS)):
                x, so_far = cut.column(cut.num_columns - 2), cut.column(cut.num_columns - 1)
                there = np.flatnonzero(x.is_valid().to_numpy(zero_copy_only=False))
                lists: list = [None] * cut.num_rows
                if len(there):
                    rows = np.array(x.drop_null().flatten().to_numpy(zero_copy_only=False), float).reshape(len(there), -1)
                    sums = contributions_of(part.value, rows) + so_far.drop_null().flatten().to_numpy().reshape(rows.shape)
                    for i, values in zip(there.tolist(), sums):
                        lists[i] = values
                yield pa.RecordBatch.from_arrays([*cut.columns[:-1], pa.array(lists, pa.list_(pa.float64()))], schema=cut.schema)

    return df.mapInArrow(run, df.schema)


def tree_contributions(df: DataFrame, model: Transformer, keep: Sequence[str], names: Sequence[str],
                       features: str = "features") -> DataFrame:
    """(keep..., base, feature, contribution): a row per row and feature slot, named as ``explain.feature_names`` gives them."""
    wide = explain_rows(df, model, keep, features)
    named = F.transform("contributions", lambda v, i: F.struct(F.get(F.array(*[F.lit(n) for n in names]), i).alias("feature"),
                                                                v.alias("contribution")))
    return wide.select(*keep, "base", F.explode(named).alias("_c")).select(*keep, "base", "_c.*")


def by_column(contributions: DataFrame, keep: Sequence[str], columns: Sequence[str], suffix: str = "_vec_") -> DataFrame:
    """Slots of one encoded column added up: (keep..., base, feature, contribution), with slots of no column by their name."""
    name = F.col("feature")
    for c in columns:
        name = F.when(F.startswith("feature", F.lit(c + suffix)), F.lit(c)).otherwise(name)
    return contributions.groupBy(*keep, "base", name.alias("feature")).agg(F.sum("contribution").alias("contribution"))

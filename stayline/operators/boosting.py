"""Second-order gradient boosting for two classes, on histograms.

Features are cut into bins once. Every level of a tree takes one pass: each task adds up gradient and curvature of its
rows per (node, feature, bin), and one small aggregate adds up the tasks. Of two siblings only the smaller one is counted,
the other is its parent less that. Splits are chosen from the sums, whose number depends on nodes, features and bins and
not on rows; leaves are -G / (H + l2). Margins are written once per tree, so a lost executor repeats one pass at most.

A null or NaN has a bin of its own, above all others, so it goes right. Rows with a null label are scored and not learned
from. Equal gains go to the first feature, then the lowest bin.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.plans.durable import cut_lineage
from stayline.plans.ordered import range_bounds


@dataclass
class Tree:
    """Nodes by number: 0 is the root, 2 i + 1 and 2 i + 2 are the children of i. A row goes left if its bin is at most
    the split's."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        for node, (feature, cut) in sorted(self.splits.items()):
            here = np.flatnonzero(at == node)
            at[here] = 2 * node + 1 + (bins[here, feature] > cut)
        return at


@dataclass
class BoostedTrees:
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def bins(self) -> Column:
        """The bin of every feature of a row: how many edges lie below its value."""
        def place(name: str, edges: list[float]) -> Column:
            x = F.col(name).cast("double")
            inner = F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>")
            below = F.size(F.filter(inner, lambda e: e < x)) if edges else F.lit(0)
            return F.when(x.isNull() | F.isnan(x), len(edges) + 1).otherwise(below)

        return F.array(*[place(n, e) for n, e in zip(self.features, self.edges)])

    def score(self, df: DataFrame) -> DataFrame:
        """Add ``margin`` and ``score``, the probability of class 1."""
        trees = self.trees

        @F.pandas_udf("double")
        def margin(bins: pd.Series) -> pd.Series:
            rows = np.array(bins.tolist(), np.int64).reshape(len(bins), -1)
            total = np.zeros(len(rows))
            for tree in trees:
                leaf = np.zeros(max(tree.leaves) + 1)
                leaf[list(tree.leaves)] = list(tree.leaves.values())
                total += leaf[tree.nodes(rows)]
            return pd.Series(total)

        out = df.withColumn("margin", F.lit(self.base) + margin(self.bins()))
        return out.withColumn("score", 1 / (1 + F.exp(-F.col("margin"))))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "edges": self.edges, "base": self.base, "trees": [
            {"splits": [[n, *s] for n, s in t.splits.items()], "leaves": list(t.leaves.items())} for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        d = json.loads(text)
        return cls(d["features"], d["edges"], d["base"], [
            Tree({n: (f, c) for n, f, c in t["splits"]}, dict(map(tuple, t["leaves"]))) for t in d["trees"]])


def histograms(rows: DataFrame, tree: Tree, wanted: Sequence[int], n_features: int, n_bins: int) -> dict[int, np.ndarray]:
    """(feature, bin, [gradient, curvature, rows]) sums of the wanted nodes, from (y, bins, margin)."""
    width = n_features * n_bins
    order = {node: i for i, node in enumerate(wanted)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(wanted) * width))
        for batch in batches:
            y, margin = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            bins = batch.column(1).flatten().to_numpy().reshape(len(y), n_features)
            at = tree.nodes(bins)
            place = np.array([order.get(n, -1) for n in range(int(at.max(initial=0)) + 1)])[at]
            own = np.flatnonzero(place >= 0)
            p = 1 / (1 + np.exp(-margin[own]))
            cell = (place[own, None] * width + np.arange(n_features) * n_bins + bins[own]).reshape(-1)
            for i, values in enumerate((p - y[own], p * (1 - p), np.ones(len(own)))):
                total[i] += np.bincount(cell, np.repeat(values, n_features), total.shape[1])
        at = np.flatnonzero(total[2])
        yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(total[i, at]) for i in range(3)]], ["cell", "g", "h", "n"])

    sums = (rows.select("y", "bins", "margin").mapInArrow(run, "cell long, g double, h double, n double")
            .groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).toPandas())  # a row per cell
    out = np.zeros((3, len(wanted) * width))
    out[:, sums["cell"].to_numpy(np.int64)] = sums[["g", "h", "n"]].to_numpy().T
    return {node: out[:, i * width:(i + 1) * width].reshape(3, n_features, n_bins) for node, i in order.items()}


def best_split(sums: np.ndarray, l2: float, least_weight: float, least_gain: float) -> tuple[int, int] | None:
    """(feature, bin) with the greatest gain, if any is above ``least_gain``."""
    g, h, n = np.cumsum(sums, axis=2)
    total_g, total_h, total_n = (x[0, -1] for x in (g, h, n))
    gain = (g ** 2 / (h + l2) + (total_g - g) ** 2 / (total_h - h + l2) - total_g ** 2 / (total_h + l2)) / 2
    fine = (h >= least_weight) & (total_h - h >= least_weight) & (n > 0) & (n < total_n)
    gain = np.where(fine, np.round(gain, 9), -np.inf)  # sums differ in their last digits with the order of tasks
    at = int(np.argmax(gain))
    feature, cut = divmod(at, sums.shape[2])
    return (feature, cut) if gain.reshape(-1)[at] > least_gain else None


def fit_boosted(df: DataFrame, features: Sequence[str], label: str = "label", rounds: int = 100, depth: int = 5, rate: float = 0.1,
                l2: float = 1.0, least_weight: float = 1.0, least_gain: float = 0.0, bins: int = 128, base_score: float = 0.5,
                edges: list[list[float]] | None = None) -> BoostedTrees:
    """Fit boosted trees on numeric columns. Bins come from a sketch of each column, which differs a little with the
    partitioning, or are the ``edges`` of an earlier fit."""
    edges = edges or [[b for b in e if abs(b) != float("inf")] for e in range_bounds(df, list(features), bins)]
    model = BoostedTrees(list(features), edges, log(base_score / (1 - base_score)))
    n_bins = max(len(e) for e in edges) + 2
    rows = cut_lineage(df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), model.bins().alias("bins"), F.lit(model.base).alias("margin")))
    for _ in range(rounds):
        tree, sums = Tree(), histograms(rows, Tree(), [0], len(features), n_bins)
        level = [0]
        for _ in range(depth):
            split = {n: s for n in level if (s := best_split(sums[n], l2, least_weight, least_gain)) is not None}
            tree.splits.update(split)
            counted = {}
            for node, (feature, cut) in split.items():
                left, whole = sums[node][2, feature, :cut + 1].sum(), sums[node][2, feature].sum()
                counted[node] = 2 * node + 1 + int(left > whole - left)
            if not counted:
                break
            fresh = histograms(rows, tree, list(counted.values()), len(features), n_bins)
            for node, child in counted.items():
                sibling = 4 * node + 3 - child
                sums[child], sums[sibling] = fresh[child], sums[node] - fresh[child]
            level = [c for n in counted for c in (2 * n + 1, 2 * n + 2)]
        for node in sums.keys() - tree.splits.keys():
            g, h, _ = sums[node][:, 0].sum(axis=1)
            tree.leaves[node] = float(-rate * g / (h + l2))
        model.trees.append(tree)
        rows = _moved(rows, tree, len(features))
    return model


def _moved(rows: DataFrame, tree: Tree, n_features: int) -> DataFrame:
    """Rows with the tree's leaves added to their margins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf = np.zeros(max(tree.leaves) + 1)
        leaf[list(tree.leaves)] = list(tree.leaves.values())
        for batch in batches:
            bins = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, n_features)
            margin = batch.column(2).to_numpy(zero_copy_only=False) + leaf[tree.nodes(bins)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(margin)], schema=batch.schema)

    return cut_lineage(rows.mapInArrow(run, rows.schema))

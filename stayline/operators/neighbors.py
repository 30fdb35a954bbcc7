"""Exact k nearest neighbours without comparing all pairs.

Space is cut into leaves of a k-d tree built from a bounded sample. Every query first searches its own leaf; the
distance of its k-th hit there is a ball outside of which nothing can be nearer, so only leaves that the ball touches
are searched as well. Equal points are merged first (only the k+1 smallest keys of a point can ever be neighbours),
and leaves with many queries are searched in slices, so a hot point or a hot leaf is never one task's problem.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.plans.durable import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy of this package

MAX_LEAVES = 4096
SAMPLE_PER_LEAF = 16
NEAR = "array<struct<d2:double,neighbor:string,point:array<double>>>"


@dataclass
class Leaves:
    """Boxes that tile the space."""

    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def build(sample: np.ndarray, wanted: int) -> Leaves:
        """Halve the fullest box at the median of its widest column until there are enough."""
        dims = sample.shape[1]
        order = count()
        boxes = [(-len(sample), next(order), sample, np.full(dims, -np.inf), np.full(dims, np.inf))]
        done = []
        while boxes and len(boxes) + len(done) < wanted:
            box = heappop(boxes)
            rows, low, high = box[2:]
            axis = int((rows.max(axis=0) - rows.min(axis=0)).argmax()) if len(rows) else 0
            values = np.unique(rows[:, axis])
            if len(values) < 2:  # nothing left to cut
                done.append(box)
                continue
            # The cut is a value above the smallest one, so both halves hold rows.
            at = float(values[max(1, np.searchsorted(values, np.median(rows[:, axis])))])
            left = rows[:, axis] < at
            cut_high, cut_low = high.copy(), low.copy()
            cut_high[axis], cut_low[axis] = at, at
            for part, lo, hi in ((rows[left], low, cut_high), (rows[~left], cut_low, high)):
                heappush(boxes, (-len(part), next(order), part, lo, hi))
        boxes += done
        return Leaves(np.array([b[3] for b in boxes]), np.array([b[4] for b in boxes]))

    def distance2(self, points: np.ndarray) -> np.ndarray:
        """Squared distance from each point to each box; 0 inside or on the edge."""
        gap = np.maximum(np.maximum(self.low[None] - points[:, None], points[:, None] - self.high[None]), 0.0)
        return (gap ** 2).sum(axis=2)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The box that holds the point; boxes are closed below and open above."""
        inside = ((points[:, None] >= self.low[None]) & (points[:, None] < self.high[None])).all(axis=2)
        return inside.argmax(axis=1)


def _chunks(n: int, width: int) -> Iterator[slice]:
    step = max(1, 4_000_000 // max(width, 1))
    return (slice(i, i + step) for i in range(0, n, step))


def nearest_rows(queries: np.ndarray, base: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, base row, d2) of the k nearest base rows; equal distances go to the earlier base row."""
    found = []
    for part in _chunks(len(queries), len(base)):
        d2 = np.zeros((len(queries[part]), len(base)))
        for axis in range(base.shape[1]):
            d2 += (queries[part, axis][:, None] - base[None, :, axis]) ** 2
        reach = np.partition(d2, k - 1, axis=1)[:, k - 1] if len(base) > k else np.full(len(d2), np.inf)
        row, col = np.nonzero(d2 <= reach[:, None])
        dist = d2[row, col]
        order = np.lexsort((col, dist, row))
        row, col, dist = row[order], col[order], dist[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < k
        found.append((row[keep] + part.start, col[keep], dist[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _search(points: DataFrame, queries: DataFrame, k: int, slice_rows: int) -> DataFrame:
    """Per (x, leaf) of ``queries`` the k nearest rows of that leaf, nearest first."""
    sizes = queries.groupBy("leaf").agg(F.ceil(F.count("*") / slice_rows).cast("int").alias("slices"))
    sizes = F.broadcast(sizes)  # one row per leaf, at most MAX_LEAVES
    asked = queries.join(sizes, "leaf").withColumn("slice", F.pmod(F.xxhash64("x"), F.col("slices")).cast("int"))
    held = points.join(sizes, "leaf").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))

    def local(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(q):
            return pd.DataFrame({"x": [], "leaf": [], "near": []}, dtype=object)
        if not len(b):
            return pd.DataFrame({"x": q["x"], "leaf": q["leaf"], "near": [[] for _ in range(len(q))]})
        rows = b.explode("keys", ignore_index=True).sort_values("keys", ignore_index=True)
        base, keys = np.stack(rows["x"].to_numpy()), rows["keys"].to_numpy()
        row, col, dist = nearest_rows(np.stack(q["x"].to_numpy()), base, k)
        near = [[] for _ in range(len(q))]
        for r, c, d in zip(row, col, dist):
            near[r].append({"d2": d, "neighbor": keys[c], "point": base[c]})
        return pd.DataFrame({"x": q["x"], "leaf": q["leaf"], "near": near})

    return (asked.select("x", "leaf", "slice").groupBy("leaf", "slice")
            .cogroup(held.select("x", "keys", "leaf", "slice").groupBy("leaf", "slice"))
            .applyInPandas(local, f"x array<double>, leaf int, near {NEAR}"))


def _place(df: DataFrame, leaves: Leaves) -> DataFrame:
    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_numpy())
                pdf["leaf"] = np.concatenate([leaves.home(x[p]) for p in _chunks(len(x), leaves.low.size)]).astype("int32")
                yield pdf

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(locate, f"{fields}, leaf int")


def _touched(found: DataFrame, leaves: Leaves, k: int) -> DataFrame:
    """(x, leaf) of the other leaves that the ball around a query reaches."""
    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x, own = np.stack(pdf["x"].to_numpy()), pdf["leaf"].to_numpy()
            limit = pdf["r2"].to_numpy(dtype=float, na_value=np.inf) * (1 + 1e-9)
            for p in _chunks(len(x), leaves.low.size):
                hit = leaves.distance2(x[p]) <= limit[p][:, None]
                hit[np.arange(len(hit)), own[p]] = False
                row, leaf = np.nonzero(hit)
                if len(row):
                    yield pd.DataFrame({"x": [x[p][r] for r in row], "leaf": leaf.astype("int32")})

    radius = F.when(F.size("near") >= k, F.element_at("near", -1)["d2"])
    return found.select("x", "leaf", radius.alias("r2")).mapInPandas(reach, "x array<double>, leaf int")


def nearest(queries: DataFrame, base: DataFrame, key: str, features: Sequence[str], k: int,
            leaf_rows: int = 4096) -> DataFrame:
    """(key, x, near): the k nearest base rows of each query row, itself left out, nearest first, ties by key.

    Keys are compared as text. Features must be non-null numbers on a common scale.
    """
    x = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    asked = queries.select(F.col(key).cast("string").alias("key"), x)
    first = W.partitionBy("x").orderBy("key")
    points = cut_lineage(
        base.select(F.col(key).cast("string").alias("key"), x)
        .withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
        .groupBy("x").agg(F.sort_array(F.collect_list("key")).alias("keys")))
    total = points.count()
    leaf_rows = max(leaf_rows, -(-total // MAX_LEAVES))
    wanted = max(1, -(-total // leaf_rows))
    sample = points.select("x").orderBy(F.xxhash64("x"), "x").limit(SAMPLE_PER_LEAF * wanted).collect()
    leaves = Leaves.build(np.array([r["x"] for r in sample]).reshape(len(sample), len(features)), wanted)

    distinct = cut_lineage(_place(asked.select("x").distinct(), leaves))  # counted, then searched
    placed = _place(points, leaves)
    found = _search(placed, distinct, k + 1, leaf_rows)
    if len(leaves.low) > 1:
        found = cut_lineage(found)  # read by the second search and by the merge
        touched = cut_lineage(_touched(found, leaves, k + 1))
        found = found.unionByName(_search(placed, touched, k + 1, leaf_rows))
    merged = found.groupBy("x").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    others = F.slice(F.filter("near", lambda n: n["neighbor"] != F.col("key")), 1, k)
    return asked.join(merged, "x").select("key", "x", others.alias("near"))

"""Approximate nearest neighbours with learned partitions.

Fitting, on at most SAMPLE vectors (first in the hash order of their ids), in one task: the sample's neighbour graph is
cut into cells of equal size by repeated bisection (smoothing along the edges, split at the median, swaps that gain most),
so near vectors tend to share a cell. A small network learns, for a vector, the cells its neighbours lie in.

Indexing: the network puts every vector into its most probable cell. Searching: a query goes to its most probable cells
and is compared there with every vector, exactly. How many cells that takes is measured: CALIBRATION queries are compared
with all vectors, and the fewest cells whose mean recall reaches TARGET are probed. A query that finds fewer than it may
goes to all cells.

Cells are dealt out in slices of about SLICE vectors and blocks of about SLICE queries, so no task holds a whole cell,
also when one vector is a third of all. Only the model (fixed size), the calibration queries' neighbours and one row per
cell reach the driver.

Defined results: vectors that are null, zero, hold null or non-finite values, have no id, or have not the most common
length (of equals the longest) take no part; of rows with one id the one with the smallest vector counts; equal scores rank by id;
fewer candidates than k give fewer rows; no vectors give no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.llm.common import settle_small, table
from stayline.llm.registry import query
from stayline.llm.text_keys import written

K = 20
SAMPLE = 8192
CELLS = 32  # whatever the number of vectors, so what queries bring back grows with the queries alone
FEWEST = 64  # vectors a cell must have on average; small tables have fewer cells
GRAPH_K = 10
HIDDEN = 128
ROUNDS = 150
CALIBRATION = 200
TARGET = 0.94
SLICE = 4096


# ------------------------------------------------------------------------------------------------- fitting, in numpy

def neighbour_graph(x: np.ndarray, k: int = GRAPH_K) -> np.ndarray:
    """Indexes of the k vectors with the largest inner product, per vector."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1024):
        near = x[a:a + 1024] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a:a + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k else 0
    return out


def _bisect(a: np.ndarray, b: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Halves of n nodes with few of the edges (a, b) between them; sizes differ by one at most."""
    degree = np.maximum(1, np.bincount(a, minlength=n))
    y = np.random.RandomState(seed).standard_normal(n)
    for _ in range(50):
        y = 0.5 * (y + np.bincount(a, y[b], n) / degree)
        y -= np.average(y, weights=degree)
        y /= np.linalg.norm(y) or 1.0
    side = np.zeros(n, bool)
    side[np.argsort(y, kind="stable")[n // 2:]] = True
    for _ in range(8):  # swap those that gain most
        crossing = side[a] != side[b]
        gain = np.bincount(a, np.where(crossing, 1.0, -1.0), n)
        left, right = (np.flatnonzero(s & (gain > 0)) for s in (~side, side))
        t = min(len(left), len(right)) // 2
        if not t:
            break
        for group in (left, right):
            best = group[np.argsort(-gain[group], kind="stable")[:t]]
            side[best] = ~side[best]
    return side


def balanced_cells(graph: np.ndarray, cells: int) -> np.ndarray:
    """Cell of each node; ``cells`` is a power of two."""
    n = len(graph)
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    cell = np.zeros(n, np.int64)
    for level in range(int(log2(cells))):
        new = np.empty(n, np.int64)
        same = cell[a] == cell[b]
        a, b = a[same], b[same]
        for c in range(1 << level):
            nodes = np.flatnonzero(cell == c)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inside = cell[a] == c
            new[nodes] = 2 * c + _bisect(place[a[inside]], place[b[inside]], len(nodes), level * 1000 + c)
        cell = new
    return cell


class Router:
    """One hidden layer; gives a score per cell."""

    def __init__(self, w1, b1, w2, b2):
        self.w1, self.b1, self.w2, self.b2 = w1, b1, w2, b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def order(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray) -> Router:
        """Cross-entropy to the shares of cells among each vector's neighbours, full batches, Adam."""
        random = np.random.RandomState(7)
        d, cells = x.shape[1], target.shape[1]
        params = [random.standard_normal((d, HIDDEN)) * (2 / d) ** 0.5, np.zeros(HIDDEN),
                  random.standard_normal((HIDDEN, cells)) * (1 / HIDDEN) ** 0.5, np.zeros(cells)]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, ROUNDS + 1):
            w1, b1, w2, b2 = params
            h = np.maximum(x @ w1 + b1, 0)
            z = h @ w2 + b2
            z = np.exp(z - z.max(axis=1, keepdims=True))
            gap = (z / z.sum(axis=1, keepdims=True) - target) / len(x)
            back = (gap @ w2.T) * (h > 0)
            slopes = [x.T @ back, back.sum(0), h.T @ gap, gap.sum(0)]
            for i, g in enumerate(slopes):
                g = g + 1e-5 * params[i]
                first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - 0.01 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        return cls(*params)


def fit_router(x: np.ndarray, cells: int) -> Router:
    x = x / (np.linalg.norm(x, axis=1).mean() or 1.0)
    if cells < 2 or len(x) < 4 * cells:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x)
    cell = balanced_cells(graph, cells)
    target = np.zeros((len(x), cells))
    lines = np.arange(len(x))
    for near in (lines, *graph.T):
        np.add.at(target, (lines, cell[near]), 1.0)
    return Router.fit(x, target / target.sum(axis=1, keepdims=True))


# ------------------------------------------------------------------------------------------------------------ tables

def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col(f"`{embedding}`")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    rows = rows.where(F.size("v") == (common["d"] if common else 0))
    twice = rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")
    return rows if twice.isEmpty() else rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def fit_index(rows: DataFrame, n: int, sample: int = SAMPLE, cells: int = CELLS) -> Router:
    cells = 1 << max(0, min(int(log2(cells)), int(log2(max(1, n / FEWEST)))))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), _matrix(b.column(1))) for b in batches if b.num_rows]
        ids, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        model = fit_router(x[np.argsort(ids)], cells)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps([model.w1, model.b1, model.w2, model.b2])]})

    chosen = F.broadcast(rows.select(F.col("vec_id").alias("chosen")).orderBy(F.xxhash64("chosen"), "chosen").limit(sample))
    found = rows.join(chosen, F.col("vec_id") == F.col("chosen")).select("vec_id", "v").repartition(1)
    return Router(*pickle.loads(found.mapInArrow(learn, "model binary").first()["model"]))


@lru_cache(maxsize=2)
def _router(packed: bytes) -> Router:
    return Router(*pickle.loads(packed))


def _packed(router: Router) -> bytes:
    return pickle.dumps([router.w1, router.b1, router.w2, router.b2])


def in_cells(rows: DataFrame, router: Router) -> DataFrame:
    """(vec_id, v, cell): each vector in its most probable cell."""
    packed, kind = _packed(router), dict(rows.dtypes)["v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = _router(packed).order(_matrix(batch.column(1)))[:, 0] if batch.num_rows else np.empty(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32))],
                                             ["vec_id", "v", "cell"])

    return rows.mapInArrow(run, f"vec_id long, v {kind}, cell int")


def best_matches(queries: np.ndarray, q_ids: np.ndarray, base: np.ndarray, ids: np.ndarray, k: int):
    """(query index, base index, score) of each query's k best among ``base``, without its own id.

    Scores of what may be among the best are summed again one component after another, so a score depends on its two
    vectors alone and equal vectors tie.
    """
    near = queries @ base.T
    near[q_ids[:, None] == ids[None, :]] = -np.inf
    slack = 1e-12 * np.linalg.norm(queries, axis=1) * (np.linalg.norm(base, axis=1).max() if len(base) else 0)
    out = []
    for i, row in enumerate(near):
        m = min(k, int((row > -np.inf).sum()))
        if not m:
            continue
        edge = np.partition(row, len(row) - m)[len(row) - m]
        at = np.flatnonzero(row >= edge - slack[i])
        at = at[row[at] > -np.inf]
        score = np.add.accumulate(base[at] * queries[i], axis=1)[:, -1]
        pick = np.lexsort((ids[at], -score))[:m]
        out.append((np.full(len(pick), i), at[pick], score[pick]))
    if not out:
        return np.empty(0, int), np.empty(0, int), np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def calibrate(cells: DataFrame, router: Router, k: int = K, target: float = TARGET) -> tuple[int, float]:
    """How many cells to probe, and the mean recall that gives, from exact neighbours of CALIBRATION vectors."""
    spark, n_cells = cells.sparkSession, len(router.b2)
    if n_cells == 1:
        return 1, 1.0
    asked = cells.orderBy(F.xxhash64(F.col("vec_id") + 1), "vec_id").limit(CALIBRATION).toPandas()  # bounded
    q_ids = asked["vec_id"].to_numpy()
    queries = np.stack([np.asarray(v, float) for v in asked["v"]])
    shared = spark.sparkContext.broadcast((q_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids_, queries_ = shared.value
        best = [np.empty(0, int), np.empty(0, np.int64), np.empty(0), np.empty(0, np.int32)]
        for batch in batches:
            ids, cell = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            q, at, score = best_matches(queries_, q_ids_, _matrix(batch.column(1)), ids, k)
            best = [np.concatenate(x) for x in zip(best, (q, ids[at], score, cell[at]))]
            order = np.lexsort((best[1], -best[2], best[0]))  # keep the k best per query
            best = [x[order] for x in best]
            begin = np.searchsorted(best[0], best[0])
            best = [x[np.arange(len(begin)) - begin < k] for x in best]
        yield pa.RecordBatch.from_arrays([pa.array(best[0].astype(np.int32)), pa.array(best[1]), pa.array(best[2]),
                                          pa.array(best[3].astype(np.int32))], ["q", "vec_id", "score", "cell"])

    found = cells.select("vec_id", "v", "cell").mapInArrow(run, "q int, vec_id long, score double, cell int")
    rank = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    true = found.withColumn("rank", rank).where(F.col("rank") <= k).select("q", "cell").toPandas()  # k rows per query
    place = np.argsort(router.order(queries), axis=1)[true["q"].to_numpy(), true["cell"].to_numpy()]
    recall = np.cumsum(np.bincount(place, minlength=n_cells)) / max(1, len(place))
    probes = int(np.argmax(recall >= min(target, recall[-1]))) + 1
    return probes, float(recall[probes - 1])


def search(queries: DataFrame, cells: DataFrame, sizes: dict[int, int], router: Router, probes: int, k: int = K,
           n_queries: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, v) ``queries`` in their ``probes`` most probable cells."""
    packed, kind = _packed(router), dict(queries.dtypes)["v"]
    blocks = max(1, ceil(n_queries * probes / max(1, len(sizes)) / SLICE))
    slices = {c: max(1, ceil(n / SLICE)) for c, n in sizes.items()}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = _router(packed).order(_matrix(batch.column(1)))[:, :probes]
            row = np.repeat(np.arange(batch.num_rows), order.shape[1])
            cell = order.reshape(-1)
            times = np.array([slices.get(c, 0) for c in cell.tolist()], np.int64)
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            take = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([take.column(0), take.column(1), pa.array(cell.astype(np.int32)),
                                              pa.array(part.astype(np.int32))], ["query_id", "q", "cell", "part"])

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not asked.num_rows or not held.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        q_ids, ids = asked["query_id"].to_numpy(), held["vec_id"].to_numpy()
        queries_, base, found = _matrix(asked["q"]), _matrix(held["v"]), []
        for a in range(0, len(q_ids), 512):
            q, at, score = best_matches(queries_[a:a + 512], q_ids[a:a + 512], base, ids, k)
            found.append((q_ids[a:a + 512][q], ids[at], score))
        return pa.table([pa.array(np.concatenate(x)) for x in zip(*found)], names)

    def block(column: str):
        return F.pmod(F.xxhash64(column, F.lit(1)), F.lit(blocks)).cast("int")

    of_cell = F.create_map(*[F.lit(x) for pair in (slices or {0: 1}).items() for x in pair])
    asked = queries.select("vec_id", "v").mapInArrow(ask, f"query_id long, q {kind}, cell int, part int").withColumn(
        "block", block("query_id"))
    held = (cells.withColumn("part", F.pmod(F.xxhash64("vec_id"), of_cell[F.col("cell")].cast("long")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    keys = ["cell", "part", "block"]
    found = asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """Each query's k nearest by inner product: (query_id, rank, vec_id, score, probes, cells)."""
    rows = written(usable(vectors), "vectors")
    n = rows.count()
    if n < 2:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"),
                           F.lit(0).alias("probes"), F.lit(0).alias("cells")).limit(0)
    router = fit_index(rows, n)
    cells = written(in_cells(rows, router), "cells")
    sizes = {r["cell"]: r["count"] for r in cells.groupBy("cell").count().collect()}  # one row per cell
    probes, _ = calibrate(cells, router, k)
    queries = rows.where(is_query)
    n_queries = queries.count()
    found = written(search(queries, cells, sizes, router, probes, k, n_queries), "found")
    short = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, n - 1)).select(
        F.col("query_id").alias("vec_id"))
    rest = written(queries.join(settle_small(short), "vec_id", "left_anti"), "short")
    left = rest.count()
    if left:
        again = search(rest, cells, sizes, router, len(router.b2), k, left)
        found = found.join(rest.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return found.withColumns({"probes": F.lit(probes), "cells": F.lit(len(router.b2))})


@query("op2_learned_partitions")
def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)

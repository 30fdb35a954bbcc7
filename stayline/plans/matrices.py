"""Sums of numeric arrays over all rows, added up by tasks and then chunk by chunk.

A task makes one array of fixed length from its rows. It leaves the task in chunks of a few kilobytes, so that no row is
large and no task holds more than its share of the total: what a sum costs depends on its length and on the number of
tasks, not on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 256  # numbers


def _rows(chunks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(chunks), pa.int32()), pa.array([c.tobytes() for c in chunks.values()], pa.binary())], ["at", "sums"])


def summed(rows: DataFrame, per_batch: Callable[[pa.RecordBatch], np.ndarray], chunk: int = CHUNK) -> DataFrame:
    """(at, sums): the array ``per_batch`` gives, added up over all batches; chunk number ``at``, doubles as bytes.

    No rows, no chunks.
    """
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = per_batch(batch).astype(np.float64, copy=False).ravel()
                total = part if total is None else total + part
        if total is not None:
            yield _rows({i: total[i * chunk:(i + 1) * chunk] for i in range(-(-len(total) // chunk))})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(sums)
                totals[at] = totals[at] + part if at in totals else part
        if totals:
            yield _rows(totals)

    kind = "at int, sums binary"
    return rows.mapInArrow(local, kind).repartition("at").mapInArrow(merge, kind)


def fetched(sums: DataFrame) -> np.ndarray | None:
    """The whole array on the driver, for sums whose length is that of a model."""
    parts = sorted((r["at"], bytes(r["sums"])) for r in sums.collect())
    return np.frombuffer(b"".join(p for _, p in parts)) if parts else None


def block(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    """An array<double> column without null rows as a matrix; a null element is NaN."""
    values = batch.column(column).flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)

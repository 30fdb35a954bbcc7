"""Tables of hundreds of columns: pairwise figures from masked cross products."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.operators.clean import numeric_columns
from stayline.plans.matrices import block, summed

FIGURES = 6  # rows, sums, squares, products of a pair
PAIRS = 42  # pairs in a chunk
FLAT = 1e-12  # a variance below this share of the mean square is rounding


def correlation_blocks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, n, r): Pearson matrix in long form, each pair over the rows where both have a value.

    Every task adds up the cross products of its rows, values and presence masks apart, so the plan does not grow with
    the number of pairs. Columns are centred on their means before, against cancellation. Memory of a task: 48 bytes a
    pair of columns and as much again while sums are added; 500 columns make about 6 MB.

    Null and NaN are missing. r is null below two common rows and where a column does not vary in them; an infinite
    value makes its pairs NaN. A table without rows gives no rows.
    """
    cols = list(columns or numeric_columns(df))
    width = len(cols)
    first, second = np.triu_indices(width)
    values = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols]
    middle = df.agg(F.array(*[F.avg(v) for v in values]).alias("m")).first()["m"]
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in middle])

    def products(batch: pa.RecordBatch) -> np.ndarray:
        x = block(batch, 0, width)
        here = ~np.isnan(x)
        x = np.where(here, x - shift, 0.0)
        mask = here.astype(np.float64)
        with np.errstate(all="ignore"):
            sums, squares = x.T @ mask, (x * x).T @ mask
            every = (mask.T @ mask, sums, sums.T, squares, squares.T, x.T @ x)
            return np.stack([e[first, second] for e in every], axis=1)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, sa, sb, qa, qb, p = np.frombuffer(sums).reshape(-1, FIGURES).T
                pair = at * PAIRS + np.arange(len(n))
                with np.errstate(all="ignore"):
                    va, vb = qa - sa * sa / n, qb - sb * sb / n
                    r = np.clip((p - sa * sb / n) / np.sqrt(va * vb), -1.0, 1.0)
                    unknown = (n < 2) | (va <= FLAT * qa) | (vb <= FLAT * qb)
                a, b = first[pair], second[pair]
                off = a != b
                left, right = np.concatenate([a, b[off]]), np.concatenate([b, a[off]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols[i] for i in left], pa.string()), pa.array([cols[i] for i in right], pa.string()),
                     pa.array(np.concatenate([n, n[off]]).astype(np.int64)),
                     pa.array(np.concatenate([r, r[off]]), pa.float64(), mask=np.concatenate([unknown, unknown[off]]))],
                    ["column_a", "column_b", "n", "r"])

    return summed(df.select(F.array(*values).alias("v")), products, PAIRS * FIGURES).mapInArrow(
        cells, "column_a string, column_b string, n long, r double")

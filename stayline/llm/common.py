"""What the text operators share: tables, words, hashing, small sides, Arrow helpers."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.plans.durable import cut_lineage

# Fixed value: what separates words
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

CACHE = 400_000
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def settle_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a narrow table once, in the shared folder; broadcast it if it has at most ``limit`` rows.

    A larger one joins through a shuffle.
    """
    kept = cut_lineage(df)
    return F.broadcast(kept) if kept.count() <= limit else kept


_AS_SPACE = str.maketrans({c: " " for c in SPACES})
_ODD_SPACE = frozenset(c for c in map(chr, range(0x3001)) if c.isspace()) - frozenset(SPACES)


def words(text: str | None) -> list[str]:
    """Maximal runs without ASCII white space."""
    if not text:
        return []
    if _ODD_SPACE.isdisjoint(text):
        return text.split()
    return [w for w in text.translate(_AS_SPACE).split(" ") if w]


class Memo(dict):
    """Remembers what ``make`` gives per key; starts afresh when full, so its memory is bounded."""

    def __init__(self, make: Callable, limit: int = CACHE):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


class Recent(Memo):
    """A Memo of at most ``limit`` keys that, when full, forgets those that were not asked for of late.

    Keys live in two halves. A full new half takes the place of the old one, and a key found in the old half moves on, so
    frequent keys stay and those asked for once go.
    """

    def __init__(self, make: Callable, limit: int = CACHE):
        super().__init__(make, max(1, limit // 2))
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old[key] if key in self.old else self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


_KEPT: dict = {}


def kept_alone(make: Callable, *args):
    """``make(*args)``, made once and kept by the Python worker until it is asked for another one.

    A worker serves stage after stage; what it remembers for one must not stay beside what the next one needs.
    """
    key = (make, args)
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            gc.collect()  # helpers refer to themselves through their memos
            pa.default_memory_pool().release_unused()
        _KEPT[key] = make(*args)
    return _KEPT[key]


def word_hashes(tokens: list[str], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, tokens), np.uint64, len(tokens))


def hash_word(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on unsigned 64-bit arrays."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` consecutive words; a shorter text has none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        base = mix(np.array([seed], np.uint64) + np.uint64(0x9E3779B97F4A7C15))[0] | np.uint64(1)
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total = total * base + hashes[i:i + n]
        return mix(total)


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def list_array(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """One list per row, without Python objects per value."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``make`` runs once per task and gives the function for each of its batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            yield step(batch)

    return df.mapInArrow(run, schema)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is computed inside passes at most ``rows`` rows at once to Python; the caller's setting holds again after.

    An executor and its workers hold a batch of every running task, outside the heap and several times over.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sha_hex(column: Column | str) -> Column:
    return F.sha2(F.col(column) if isinstance(column, str) else column, 256)


def slices(batch: pa.RecordBatch, column: int, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text takes at most ``limit`` bytes, or one row each beyond that."""
    texts = batch.column(column)
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts], np.int64)
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if size + n > limit and i > start:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)

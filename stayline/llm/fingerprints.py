"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases the LZ78 way: each phrase is the shortest run of characters that is not in the
text's dictionary yet. Phrases are hashed, and the smallest hashes of the phrase set are the fingerprint. The share of
common values among the smallest of two fingerprints' union estimates the Jaccard likeness of the phrase sets, which
follows how well one text compresses the other.

To compare each document with the next one, and with a text whose tail is the next one's head, documents are cut into
ranges of ids and sorted inside them; the first document of a range is copied to the range before it. Texts cross one
shuffle, and a task holds two documents at a time.

Defined results: a null text counts as empty; an empty text has an empty fingerprint, and two empty ones are alike (1),
an empty and another one not (0). A leftover run at a text's end that is in the dictionary already adds no phrase, unless
it is all there is. Order is descending id, nulls last, equal ids by text; after the last document comes the first; a single
document is its own next one.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import documents, mix
from stayline.llm.registry import query
from stayline.plans.ordered import range_bounds

SIZE = 128  # values kept per fingerprint
RANGES = 4  # id ranges per shuffle partition, to even out what hashing them deals to each
FEWEST_RANGES = 64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Parse:
    """An LZ78 parse that can be taken back to a mark."""

    __slots__ = ("ends", "node", "root", "undo")

    def __init__(self):
        self.root: dict = {}
        self.node, self.ends, self.undo = self.root, [], None

    def feed(self, text: str, start: int = 0) -> None:
        """Go on with ``text``, whose first character stands at ``start``; ``ends`` gets the end of each new phrase."""
        root, node, ends, undo = self.root, self.node, self.ends, self.undo
        if undo is None:
            for at, char in enumerate(text, start + 1):
                follow = node.get(char)
                if follow is None:
                    node[char] = {}
                    node = root
                    ends.append(at)
                else:
                    node = follow
        else:
            for at, char in enumerate(text, start + 1):
                follow = node.get(char)
                if follow is None:
                    node[char] = {}
                    undo.append((node, char))
                    node = root
                    ends.append(at)
                else:
                    node = follow
        self.node = node

    def mark(self) -> tuple[int, dict]:
        self.undo = []
        return len(self.ends), self.node

    def back(self, mark: tuple[int, dict]) -> None:
        for node, char in self.undo:
            del node[char]
        del self.ends[mark[0]:]
        self.node, self.undo = mark[1], None


def smallest_hashes(text: str, ends: list[int], size: int = SIZE) -> np.ndarray:
    """The smallest 32-bit hashes of the phrases that end at ``ends``, ascending.

    Phrase hashes come from one polynomial over the whole text: the difference of two prefix sums, moved to the front.
    """
    if not text:
        return np.empty(0, np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    stop = np.array(ends or [len(text)], np.int64)
    begin = np.concatenate([[0], stop[:-1]])
    with np.errstate(over="ignore"):
        n = len(codes) + 1
        power = np.full(n, _BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        shift = np.full(n, _INVERSE, np.uint64)
        shift[0] = 1
        shift = np.multiply.accumulate(shift)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes + _BASE) * power[:-1], dtype=np.uint64)])
        values = mix((sums[stop] - sums[begin]) * shift[begin])
    return np.unique((values >> np.uint64(32)).astype(np.uint32))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIZE) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:size]
    return float(np.isin(union, a, assume_unique=True)[np.isin(union, b, assume_unique=True)].sum() / len(union))


def as_text(values: np.ndarray) -> str:
    return values.astype(">u4").tobytes().hex()


def fingerprint(text: str, size: int = SIZE) -> np.ndarray:
    parse = Parse()
    parse.feed(text)
    return smallest_hashes(text, parse.ends, size)


def with_edit(text: str, head: str, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of ``text`` and of the text whose second half is the beginning of ``head``; the first half is
    parsed once for both."""
    half = len(text) // 2
    keep = text[:len(text) - half]
    edited = keep + head[:half]
    parse = Parse()
    parse.feed(keep)
    mark = parse.mark()
    parse.feed(edited[len(keep):], len(keep))
    changed = smallest_hashes(edited, parse.ends, size)
    parse.back(mark)
    parse.feed(text[len(keep):], len(keep))
    return smallest_hashes(text, parse.ends, size), changed, edited


# ------------------------------------------------------------------------------------------------ over documents

def _ranged(docs: DataFrame) -> DataFrame:
    """(doc_id, text, part, copy): every document in its id range, and each range's first ones also in the one before."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = max(FEWEST_RANGES, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = np.array([b for b in range_bounds(rows.where("doc_id is not null"), ["doc_id"], ranges)[0]
                      if abs(b) != float("inf")])

    @F.pandas_udf("int")
    def part_of(ids):
        # larger ids stand in earlier parts, null ids in the last one
        number = len(edges) - np.searchsorted(edges, ids.to_numpy(dtype=float, na_value=-np.inf), "right")
        return pd.Series(number.astype(np.int32))

    placed = rows.withColumn("part", part_of("doc_id"))
    first = (placed.groupBy("part").agg(F.max("doc_id").alias("top")).collect())  # one row per range
    order = sorted(first, key=lambda r: r["part"])
    heads = [(r["part"], r["top"], order[i - 1]["part"]) for i, r in enumerate(order)]
    to = F.broadcast(spark.createDataFrame(heads, "of int, top long, before int"))
    joined = placed.join(to, F.col("part") == F.col("of"))
    here = F.struct(F.col("part").alias("part"), F.lit(False).alias("copy"))
    there = F.struct(F.col("before").alias("part"), F.lit(True).alias("copy"))
    is_head = F.col("doc_id").eqNullSafe(F.col("top"))
    return (joined.withColumn("at", F.explode(F.when(is_head, F.array(here, there)).otherwise(F.array(here))))
            .select("doc_id", "text", "at.part", "at.copy"))


def fingerprint_documents(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = waiting = None  # a document without its next one, and one whose next one is not parsed yet
        gc.disable()  # tries hold no cycles
        try:
            for batch in batches:
                done: list[tuple] = []
                for i in range(batch.num_rows):
                    doc, text, part, copy = (batch.column(c)[i].as_py() for c in range(4))
                    if held is None or held[2] != part:
                        held, waiting = (None if copy else (doc, text, part)), None
                        continue
                    own, changed, edited = with_edit(held[1], text, size)
                    if waiting is not None:
                        done.append((*waiting, likeness(waiting[3], own, size)))
                    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    waiting = (held[0], len(held[1]), digest, own, changed, likeness(own, changed, size))
                    held = (doc, text, part)
                    if copy:
                        done.append((*waiting, likeness(own, fingerprint(text, size), size)))
                        held = waiting = None
                yield as_batch(done)
        finally:
            gc.enable()

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows], pa.string()), pa.array([as_text(r[3]) for r in rows], pa.string()),
            pa.array([as_text(r[4]) for r in rows], pa.string()),
            pa.array([r[5] for r in rows], pa.float64()), pa.array([r[6] for r in rows], pa.float64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    spread = _ranged(docs).repartition("part").sortWithinPartitions(
        "part", "copy", F.col("doc_id").desc_nulls_last(), "text")
    return spread.mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document beside that of its edited text and of the next document."""
    return fingerprint_documents(documents(spark, sf_dir))

"""Narrow stand-ins for texts: keys of word sequences, and presence maps that prune before a shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.llm.common import mix, words
from stayline.plans.durable import work_path

NULL_DOC = (1 << 63) - 1  # null ids come after all others
MAP_BITS = 26  # 8 MB whatever the data


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a narrow table to the shared folder and read it back: cuts lineage, compressed."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tkey, text): the id (null last) and a hash of the text tell rows apart that share an id."""
    return docs.select(doc_key(F.col(f"`{doc_id}`")).alias("doc"), F.xxhash64(F.col(f"`{text}`")).alias("tkey"),
                       F.col(f"`{text}`").alias("text"))


def doc_key(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(NULL_DOC))


def doc_value(doc: Column) -> Column:
    return F.when(doc != NULL_DOC, doc)


def word_digest(tokens: list[str]) -> bytes:
    return hashlib.sha256(" ".join(tokens).encode("utf-8", "surrogatepass")).digest()


def node_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def word_table(rows: DataFrame) -> DataFrame:
    """(doc, tkey, n_words, node, words_sha256) of (doc, tkey, text): texts with equal words share node and digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = [], []
            for text in batch.column(2):
                tokens = words(text.as_py())
                counts.append(len(tokens))
                digests.append(word_digest(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int32()),
                 pa.array([node_of(d) for d in digests], pa.int64()), pa.array([d.hex() for d in digests], pa.string())],
                ["doc", "tkey", "n_words", "node", "words_sha256"])

    return rows.mapInArrow(run, "doc long, tkey long, n_words int, node long, words_sha256 string")


def presence_map(hashes: DataFrame, column: str, bits: int = MAP_BITS) -> np.ndarray:
    """A bit per hash value modulo 2^bits, set by the values of ``column``.

    Its size is fixed. With more values it lets more foreign ones through; what it keeps out is never a member, so a
    join after it decides and the map only saves shuffling.
    """
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    rows = (hashes.select(F.shiftright(place, 6).cast("int").alias("at"), bit.alias("bit"))
            .groupBy("at").agg(F.expr("bit_or(bit)").alias("word")).toArrow())  # at most 2^(bits - 6) rows
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["at"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return out


def is_present(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes the map lets through."""
    place = hashes & np.uint64(len(found) * 64 - 1)
    return (found[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


COPIES = 1_000_000  # ids of copies that may be broadcast


def searched_texts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, searched) of (doc, tkey, text): the word table with ``first``, the smallest id with the same words, and
    the rows without those that copy a smaller id.

    The keys of copies are broadcast while they are few enough, and joined through a shuffle beyond that.
    """
    table = written(word_table(rows), "words")
    alike = (table.groupBy("words_sha256").agg(F.min("doc").alias("first"), F.count("*").alias("n")).where("n > 1")
             .select(F.col("words_sha256").alias("same"), "first"))
    table = written(table.join(alike, F.col("words_sha256") == F.col("same"), "left")
                    .withColumn("first", F.coalesce("first", "doc")).drop("same"), "words")
    copies = written(table.where("doc > first").select(F.col("doc").alias("copy_doc"), F.col("tkey").alias("copy_key")).distinct(), "copies")
    same = (F.col("doc") == F.col("copy_doc")) & (F.col("tkey") == F.col("copy_key"))
    return table, rows.join(F.broadcast(copies) if copies.count() <= COPIES else copies, same, "left_anti")


def mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """One 64-bit hash of two."""
    with np.errstate(over="ignore"):
        return mix(mix(a) * np.uint64(0x9E3779B97F4A7C15) + (np.uint64(b) if isinstance(b, int) else b.astype(np.uint64)))

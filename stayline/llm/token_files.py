"""Token ids of a corpus as raw payload files with a minimal perfect hash index.

One shard is one range of document ids in ascending order. `NNNNN.bin` holds the ids of its documents one after another,
as little-endian unsigned integers of 2 bytes when the vocabulary fits, else 4. `NNNNN.idx` maps a document id to its
place: a minimal perfect hash (levels of bit vectors; a key lives in the first level where it met no other key) gives a
slot, the slot's stored fingerprint tells a present key from a foreign one, and the slot's entry gives first row and
number of rows. A table over the rows of the shard has their offsets. A lookup reads a bounded number of words whatever
the number of keys.

Spark range-partitions the documents; each task streams its shard to a file of its own name and moves it in place when
it is whole, so a repeated task replaces its own file with the same bytes. Only one line per shard reaches the driver
(the manifest). Files go to the folder in spark.checkpoint.dir, or to the one the caller names, through pyarrow's file
systems.

Defined results: a null or empty text has only the end id; a null document id is a key of its own, before all others;
rows with equal ids stand next to each other, ordered by text; an empty table has no shards and no rows.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import CACHE, Memo, documents, mix
from stayline.llm.registry import query
from stayline.plans.durable import work_path

END_ID = 1
NULL_KEY = -(1 << 63)
LEVELS = 32
ROOM = 2  # bits per key in a level
SIGNS = ".,;:!?$%&#*|"  # ASCII signs that end a word; not the apostrophe, which binds letters
LETTERS = "A-Za-zÀ-ÖØ-öø-į"  # stay one letter, composed and in lower case
ENDING = re.compile(f"[{SIGNS}](?<=[{LETTERS}].)[{SIGNS}]*(?![^ ])")  # signs between a letter and a space or the end


# ---------------------------------------------------------------------------------------------- minimal perfect hash

def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 2 + 1))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (_level_hash(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Bit vectors of the levels, joined, with the number of ones before each 64-bit word."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.bitwise_count(bits).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct 64-bit integers. Keys left after the last level are kept sorted."""
        sizes, words, left = [], [], np.asarray(keys, np.int64)
        for level in range(LEVELS):
            if not len(left):
                break
            size = -(-len(left) * ROOM // 64) * 64
            at = (_level_hash(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.empty(0, np.uint64), np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; foreign keys get any slot or -1."""
        keys = np.asarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (_level_hash(keys[open_], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_[hit]] = (self.before[word] + np.bitwise_count(below))[hit]
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.searchsorted(self.rest, keys[open_])
            hit = (at < len(self.rest)) & (self.rest[np.minimum(at, len(self.rest) - 1)] == keys[open_])
            out[open_[hit]] = self.before[-1] + at[hit]
        return out


# ---------------------------------------------------------------------------------------------------- shard files

_INDEX = ("sizes", "bits", "rest", "prints", "first", "count", "offsets")
_TYPES = dict(zip(_INDEX, ("<i8", "<u8", "<i8", "<u4", "<u4", "<u4", "<u8")))
MAGIC = b"TOKIDX01"


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def index_bytes(keys: np.ndarray, lengths: np.ndarray) -> bytes:
    """Index of rows in key order with their numbers of ids."""
    unique, first, count = np.unique(keys, return_index=True, return_counts=True)
    hashed = PerfectHash.build(unique)
    slot = hashed.slots(unique)
    parts = {"sizes": hashed.sizes, "bits": hashed.bits, "rest": hashed.rest,
             "prints": np.empty(len(unique), np.uint32), "first": np.empty(len(unique), np.uint32),
             "count": np.empty(len(unique), np.uint32), "offsets": np.concatenate([[0], np.cumsum(lengths)])}
    parts["prints"][slot], parts["first"][slot], parts["count"][slot] = fingerprints(unique), first, count
    arrays = [np.ascontiguousarray(parts[name], _TYPES[name]) for name in _INDEX]
    return b"".join([MAGIC, np.array([len(a) for a in arrays], "<u8").tobytes(), *[a.tobytes() for a in arrays]])


class Shard:
    """A shard opened for keyed reads."""

    def __init__(self, folder: str, shard: int, width: int):
        files, path = _open(folder)
        raw = files.open_input_stream(f"{path}/{shard:05d}.idx").read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{folder}/{shard:05d}.idx is no index")
        sizes, at, parts = np.frombuffer(raw, "<u8", len(_INDEX), 8), 8 + 8 * len(_INDEX), {}
        for name, n in zip(_INDEX, sizes.tolist()):
            parts[name] = np.frombuffer(raw, _TYPES[name], n, at)
            at += parts[name].nbytes
        self.hash = PerfectHash(parts["sizes"], parts["bits"], parts["rest"])
        self.prints, self.first, self.count, self.offsets = (parts[k] for k in ("prints", "first", "count", "offsets"))
        self.file, self.type = files.open_input_file(f"{path}/{shard:05d}.bin"), np.dtype(f"<u{width}")

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows per key; 0 rows for a key that is not there."""
        if not len(self.prints):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        slot = self.hash.slots(keys)
        safe = np.maximum(slot, 0)
        there = (slot >= 0) & (self.prints[safe] == fingerprints(keys))
        return np.where(there, self.first[safe], 0), np.where(there, self.count[safe], 0)

    def ids(self, row: int) -> np.ndarray:
        a, b = int(self.offsets[row]), int(self.offsets[row + 1])
        size = self.type.itemsize
        return np.frombuffer(self.file.read_at((b - a) * size, a * size), self.type)


# ------------------------------------------------------------------------------------------------------- encoding

@lru_cache(maxsize=2)
def encoder(path: str):
    """Text to ids as bytes of unsigned ``width``-byte integers, and the width. One per Python worker.

    Nothing of this kind of vocabulary reaches across a space, a line end, or the border of a letter and a sign, so
    words and the signs behind them are encoded by the library once and remembered, also from task to task. Whether that
    holds is looked up in the tokenizer's own settings; otherwise whole texts are encoded.
    """
    import json

    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        settings = json.load(f)
    tokenizer = Tokenizer.from_file(path)
    width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4

    def encode(text: str) -> bytes:
        ids = array("H" if width == 2 else "I", tokenizer.encode(text, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    if not _splits_at_space(settings):
        return lambda text: encode(text) if text else b"", width
    lowers = any(n.get("type") == "Lowercase" for n in settings["normalizer"]["normalizers"])

    def piece(chunk: str) -> bytes:
        if lowers and chunk.isascii() and chunk.isalpha() and not chunk.islower():
            return memo[chunk.lower()]
        return encode(chunk)

    memo = Memo(piece, 2 * CACHE)

    def whole(text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(memo.__getitem__, ENDING.sub(r" \g<0>", text.replace("\n", " ")).split(" ")))

    memo[""] = b""
    return whole, width


def _splits_at_space(settings: dict) -> bool:
    """White space is made one space, then everything that is not a listed run of other characters is dropped."""
    steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = next((s for s in steps if s.get("type") == "Split"), {})
    normalizers = (settings.get("normalizer") or {}).get("normalizers", [])
    shrinks = any(n.get("type") == "Replace" and n.get("pattern") == {"Regex": "\\s+"} and n.get("content") == " "
                  for n in normalizers)
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"])
                for t in settings.get("added_tokens", []))
    pattern = split.get("pattern", {}).get("Regex", "")
    return (shrinks and plain and split.get("behavior") == "Removed" and bool(split.get("invert"))
            and r"[^\s\p{L}\p{N}]+" in pattern and " " not in pattern)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                      partitions: int | None = None) -> DataFrame:
    """Write the shards of (doc_id, text) below ``folder``; the manifest has one row per shard:
    (shard, width, n_docs, n_tokens, low, high, start)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    spread = rows.repartitionByRange(partitions, "key") if partitions else rows.repartitionByRange("key")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        encode, width = encoder(tokenizer)
        end = np.array([end_id], f"<u{width}").tobytes()
        files, path = _open(folder)
        draft, keys, lengths, out = f"{path}/draft-{shard:05d}-{attempt}", [], [], None
        for batch in batches:
            if out is None:
                files.create_dir(path, recursive=True)
                out = files.open_output_stream(f"{draft}.bin")
            keys.append(batch.column(0).to_numpy())
            texts = batch.column(1)
            sizes = np.empty(len(texts), np.int64)
            for i, text in enumerate(texts):
                payload = encode(text.as_py()) + end
                sizes[i] = len(payload) // width
                out.write(payload)
            lengths.append(sizes)
        if out is None:
            return
        out.close()
        key, length = np.concatenate(keys), np.concatenate(lengths)
        with files.open_output_stream(f"{draft}.idx") as f:
            f.write(index_bytes(key, length))
        for end_of in ("bin", "idx"):
            files.move(f"{draft}.{end_of}", f"{path}/{shard:05d}.{end_of}")
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "width": pa.array([width], pa.int32()),
            "n_docs": pa.array([len(key)], pa.int64()), "n_tokens": pa.array([int(length.sum())], pa.int64()),
            "low": pa.array([int(key[0])], pa.int64()), "high": pa.array([int(key[-1])], pa.int64())})

    written = (spread.sortWithinPartitions("key", "text")
               .mapInArrow(write, "shard int, width int, n_docs long, n_tokens long, low long, high long").collect())
    start, manifest = 0, []
    for row in sorted(written, key=lambda r: r["shard"]):  # one row per shard
        manifest.append((*row, start))
        start += row["n_tokens"]
    return spark.createDataFrame(
        manifest, "shard int, width int, n_docs long, n_tokens long, low long, high long, start long")


def read_tokens(keys: DataFrame, folder: str, manifest: DataFrame) -> DataFrame:
    """Look up every doc_id of ``keys`` in the files: (doc_id, shard, start, n_tokens, ids_crc32), one row per document.

    Keys are grouped by shard, so that a task opens few shards; within one each key is a constant-time lookup.
    """
    shards = [r.asDict() for r in manifest.orderBy("shard").collect()]  # one row per shard
    lows = np.array([s["low"] for s in shards], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.maximum(np.searchsorted(lows, batch.column(0).to_numpy(), "right") - 1, 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at.astype(np.int32))], ["key", "at"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, at = None, -1
        for batch in batches:
            keys_, ats = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in np.unique(ats).tolist():
                if i != at:
                    opened, at = Shard(folder, shards[i]["shard"], shards[i]["width"]), i
                mine = keys_[ats == i]
                first, count = opened.places(mine)
                row = np.repeat(first, count) + np.concatenate([np.arange(c) for c in count] or [np.empty(0, int)])
                ids = np.repeat(mine, count)
                crc = np.empty(len(row), np.int64)
                for j, r in enumerate(row.astype(np.int64).tolist()):
                    crc[j] = zlib.crc32(opened.ids(r).astype("<u4").tobytes())
                row = row.astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, mask=ids == NULL_KEY), pa.array(np.full(len(row), shards[i]["shard"], np.int32)),
                    pa.array(opened.offsets[row].astype(np.int64) + shards[i]["start"]),
                    pa.array((opened.offsets[row + 1] - opened.offsets[row]).astype(np.int64)), pa.array(crc)],
                    ["doc_id", "shard", "start", "n_tokens", "ids_crc32"])

    wanted = keys.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()
    return (wanted.mapInArrow(place, "key long, at int").repartition(max(1, len(shards)), "at").sortWithinPartitions("at", "key")
            .mapInArrow(look_up, "doc_id long, shard int, start long, n_tokens long, ids_crc32 long"))


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as payload and index files and looked up again by key."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    folder = work_path(spark, "tokens")
    manifest = write_token_files(docs, folder, vocabulary_path("word_bpe_49k.json"))
    return read_tokens(docs, folder, manifest)

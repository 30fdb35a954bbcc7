"""Alignment of two tokenizers' tokens.

Both tokenizers spell the same bytes. Tokens of the two that overlap belong together; the groups end where a token of
each ends. They are found by pointer jumping: every token points to the token farthest to the right that it overlaps,
a token that ends where another one ends to the first tokenizer's, and pointers are replaced by their targets' pointers,
for all tokens at once, until nothing changes. Each token then points to the last one of its group, which labels it.
The number of rounds is the logarithm of the longest chain.

A text is cut into chunks where neither tokenizer can join anything, as their files say: before a space that follows no
white space. Chunks are encoded by the libraries and aligned once each and remembered per Python worker, in bounded
memory. Where a file does not say so a chunk is the whole text.

Links, token pairs that end together, are counted over the corpus. Of two linked tokens one ends with the other, so there
are at most as many different pairs as the tokens of both vocabularies have bytes; their counts alone are broadcast. The
links of a text are written once, as numbers, and summed without leaving the JVM.

Defined results: a null or empty text, or one whose bytes a tokenizer does not give back (one with the escape U+2581),
has no tokens; the strings of special tokens are plain text; each row is judged by itself and all rows count for the
links, repeated ones repeatedly; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import documents, list_array, settle_small, sha_hex, slices, small_batches
from stayline.llm.registry import query
from stayline.llm.token_files import vocabulary_path
from stayline.plans.durable import work_path

SPACE = "▁"  # fixed value of the piece model's format
PAIRS = 1_000_000  # linked pairs of tokens that are broadcast
CHUNKS, CHUNK_BYTES = 150_000, 24 << 20  # remembered per worker
LEARNT = 5_000  # chunks encoded at once: the tokenizers' results take some hundred bytes a token
BATCH_BYTES = 1 << 20


# ------------------------------------------------------------------------------------------------- the two tokenizers

def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one above U+00FF."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}


class ByteLevel:
    """A byte-level BPE file; texts are encoded with a space in front."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters, vocabulary = byte_letters(), self.tokenizer.get_vocab()
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        before = settings.get("pre_tokenizer") or {}
        self.cuts_at_space = (settings.get("normalizer") is None and before.get("type") == "ByteLevel"
                              and before.get("use_regex") is True and before.get("add_prefix_space") is False
                              and all(t["special"] for t in settings.get("added_tokens", [])))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A piece model that puts a space in front itself."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as format_

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.processor.vocab_size()
        pieces = [self.processor.id_to_piece(i) for i in range(n)]
        self.spelled = [bytes([int(p[3:5], 16)]) if self.processor.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        model = format_.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        self.cuts_at_space = (norm.add_dummy_prefix and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
                              and not model.trainer_spec.treat_whitespace_as_suffix
                              and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode([t[1:] for t in texts], num_threads=1)


# ------------------------------------------------------------------------------------------------------- pointer jumping

def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, by the number of the group's last A token. ``ends_*`` are ascending byte
    offsets behind the tokens; the last two are equal."""
    n = len(ends_a)
    over_b = np.searchsorted(ends_b, ends_a - 1, "right")  # the token of B that holds the last byte
    over_a = np.searchsorted(ends_a, ends_b - 1, "right")
    point = np.concatenate([np.where(ends_b[over_b] > ends_a, n + over_b, np.arange(n)), over_a])
    while True:
        further = point[point]
        if np.array_equal(further, point):
            return point[:n], point[n:]
        point = further


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... of each length, one after another."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)


class Aligner:
    """Aligns texts, remembering chunks."""

    def __init__(self, path_a: str, path_b: str, chunks: int = CHUNKS, chunk_bytes: int = CHUNK_BYTES):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.bytes_a, self.bytes_b = (np.array([len(s) for s in t.spelled], np.int64) for t in (self.a, self.b))
        self.signed = [f"{i}{c}" for i in range(max(len(self.a.spelled), len(self.b.spelled))) for c in ",|;\n"]
        self.cuts = self.a.cuts_at_space and self.b.cuts_at_space
        self.glued = re.compile(r"\s(?: |\Z)|^ ")
        self.limits = chunks, chunk_bytes
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.groups: list[str] = []
        self.counts = np.empty((0, 4), np.int64)  # right, n_a, n_b, n_groups
        self.links, self.link_starts = np.empty(0, np.int64), np.zeros(1, np.int64)

    def chunks(self, text: str) -> list[str]:
        """Parts of space + text; both tokenizers treat each one by itself."""
        if not self.cuts:
            return [" " + text]
        parts = (" " + text.replace(" ", "\0 ")).split("\0") if "\0" not in text else [" " + p for p in text.split(" ")]
        if not self.glued.search(text):
            return parts
        out: list[str] = []
        for part in parts:
            if out and out[-1][-1].isspace():
                out[-1] += part
            else:
                out.append(part)
        if out[-1] == " " and len(out) > 1:  # a piece model gives nothing for an empty text
            out[-2:] = [out[-2] + " "]
        return out

    def learn(self, new: list[str]) -> None:
        """Encode and align chunks. Those that may stand before others are encoded as one text, and one by one if a
        tokenizer does not give back its bytes."""
        joined = [c for c in new if not c[-1].isspace()] if self.cuts else []
        alone = [c for c in new if c[-1].isspace()] if self.cuts else new
        for some in (joined[i:i + LEARNT] for i in range(0, len(joined), LEARNT)):
            if not self._learn(some, True):
                self._learn(some, False)
        for some in (alone[i:i + LEARNT] for i in range(0, len(alone), LEARNT)):
            self._learn(some, False)

    def _learn(self, new: list[str], as_one: bool) -> bool:
        if not new:
            return True
        raw = [c.encode() for c in new]
        texts = ["".join(new)] if as_one else new
        ids_a, ids_b = ([np.array(x, np.int64) for x in t.encode(texts)] for t in (self.a, self.b))
        right = np.array([b"".join([self.a.spelled[i] for i in x.tolist()]) == r == b"".join([self.b.spelled[i] for i in y.tolist()])
                          for x, y, r in zip(ids_a, ids_b, [b"".join(raw)] if as_one else raw)])
        if as_one and not right[0]:
            return False
        a, b = (np.concatenate([np.empty(0, np.int64), *[x for x, ok in zip(ids, right) if ok]]) for ids in (ids_a, ids_b))
        right = np.broadcast_to(right, len(new)).astype(np.int64)
        self._keep(new, right, np.array([len(r) for r in raw], np.int64) * right, a, b)
        return True

    def _keep(self, new: list[str], right: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """Remember chunks of these sizes in bytes, made of the tokens a and b."""
        ends_a, ends_b = np.cumsum(self.bytes_a[a]), np.cumsum(self.bytes_b[b])
        n, stops = len(new), np.cumsum(sizes)
        own_a, own_b = np.searchsorted(stops, ends_a), np.searchsorted(stops, ends_b)
        of_a, of_b = group_ends(ends_a, ends_b)
        last = of_a == np.arange(len(a))
        mate = np.searchsorted(ends_b, ends_a)
        linked = ends_b[mate] == ends_a
        links = a[linked] * len(self.b.spelled) + b[mate[linked]]
        texts = self._written(a, b, of_a, of_b, own_a)
        count = lambda owner: np.bincount(owner, minlength=n)
        written = [""] * n
        for i, text in zip(np.flatnonzero(right).tolist(), texts):
            written[i] = text
        base = len(self.number)
        self.number.update((c, base + i) for i, c in enumerate(new))
        self.held += int(sizes.sum()) + sum(map(len, texts)) + 8 * len(links)
        self.groups += written
        self.counts = np.concatenate([self.counts, np.stack([right, count(own_a), count(own_b), count(own_a[last])], 1)])
        self.link_starts = np.concatenate([self.link_starts, self.link_starts[-1] + np.cumsum(count(own_a[linked]))])
        self.links = np.concatenate([self.links, links])

    def _written(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, owner: np.ndarray) -> list[str]:
        """The groups of each chunk as text: every id with the sign that follows it."""
        if not len(a):
            return []
        group = np.concatenate([of_a, of_b])
        order = np.argsort(group * 2 + np.repeat([0, 1], [len(a), len(b)]), kind="stable")
        group, second, id_ = group[order], order >= len(a), np.concatenate([a, b])[order]
        ends = np.concatenate([group[1:] != group[:-1], [True]])
        turns = np.concatenate([second[1:] != second[:-1], [True]])
        chunk_ends = ends & np.concatenate([owner[group[1:]] != owner[group[:-1]], [True]])
        sign = np.where(chunk_ends, 3, np.where(ends, 2, np.where(turns, 1, 0)))
        return "".join(map(self.signed.__getitem__, (id_ * 4 + sign).tolist())).split("\n")[:-1]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], list[np.ndarray]]:
        """(n_a, n_b, n_groups) rows, groups as text and links of each text."""
        if len(self.number) > self.limits[0] or self.held > self.limits[1]:
            self.forget()
        parts = [self.chunks(t) if t else [] for t in texts]
        new = list(dict.fromkeys(c for p in parts for c in p if c not in self.number))
        if new:
            self.learn(new)
        out, groups, links = np.zeros((len(texts), 3), np.int64), [], []
        for i, part in enumerate(parts):
            at = np.fromiter(map(self.number.__getitem__, part), np.int64, len(part))
            own = self.counts[at]
            if not len(at) or not own[:, 0].all():
                groups.append("")
                links.append(self.links[:0])
                continue
            out[i] = own[:, 1:].sum(axis=0)
            groups.append(";".join([self.groups[k] for k in at.tolist()]))
            starts = self.link_starts[at]
            links.append(self.links[_ragged(starts, self.link_starts[at + 1] - starts)])
        return out, groups, links


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker."""
    return Aligner(path_a, path_b)


# -------------------------------------------------------------------------------------------------------- in Spark

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links array<long>"


def align_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, links) for every row of (doc_id, text).

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of A and of B, group by group. A link is the number a * |B| + b.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                counts, groups, links = own.align(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(counts[:, i]) for i in range(3)], pa.array(groups, pa.string()),
                     list_array(links, pa.int64())], ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(link, a, b, n, best): how often each pair of tokens is linked, and whether B's token is linked no more often
    with another one of A."""
    n = aligned.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n"))
    pairs = n.select("link", F.expr(f"link div {size_b}").alias("a"), (F.col("link") % size_b).alias("b"), "n")
    most = pairs.groupBy(F.col("b").alias("of")).agg(F.max("n").alias("most"))
    return pairs.join(most, F.col("b") == F.col("of")).select("link", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def link_sums(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(of, n_links, n_best, count_sum) of (row, links): sums over the links of each row; rows without links are absent."""
    each = rows.select(F.col("row").alias("of"), F.explode("links").alias("link"))
    return each.join(counts.select("link", "n", "best"), "link").groupBy("of").agg(
        F.count("*").alias("n_links"), F.sum(F.col("best").cast("long")).alias("n_best"), F.sum("n").alias("count_sum"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, per document, with corpus-wide counts of the links."""
    path_a, path_b = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    aligned = align_texts(documents(spark, sf_dir).select("doc_id", "text"), path_a, path_b)
    digest = F.when(F.col("n_a") > 0, sha_hex("groups")).otherwise("")
    folder = work_path(spark, "aligned")
    # links repeat as texts do: plain numbers compress better than numbers of a dictionary
    with small_batches(spark):
        (aligned.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", "n_groups", digest.alias("groups_sha256"), "links")
         .write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(folder))
    rows = spark.read.parquet(folder)
    counts = settle_small(link_counts(rows, len(Pieces(path_b).spelled)), PAIRS)
    sums = link_sums(rows, counts)
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return rows.join(sums, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256")

"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends and whose length is at least max(SHORTEST, REPEATS * q).

Scales are dyadic: scale L looks for periods from L to 2 L - 1, the lowest one (L = BASE) for all below 2 BASE. Every
L-th word opens a block of min(L, BLOCK) words. How often the block stands, without a mismatch, at each distance of the
scale is one convolution: the sum of squared differences of word numbers is the block's squares, plus the window's
squares, less twice their correlation, computed modulo a prime by number-theoretic transforms. Words of all texts of a
batch go through the transforms together, which are matrix products of whole numbers below 2^53, so they are exact. A
run of at least three periods holds a whole block of its scale and the block's next occurrence, so none is missed. A sum
that is zero modulo the prime only is sorted out when the distance is extended: words that far apart are compared to both
sides, which gives the stretch. Distances are taken in ascending order, so the first one of a stretch is its smallest
period.

Texts longer than a block's scale need no longer transforms: windows are cut into segments of a block's length. The work
is n log^2 n for n words, the memory that of the text.

Defined results: null and empty texts have no words and no runs; each row is judged by itself, so repeated rows and ids
give repeated results; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import documents, sha_hex, slices, words
from stayline.llm.registry import query

SHORTEST = 24
REPEATS = 3
BASE = 8
BLOCK = 1024
PRIME = 7340033  # 7 * 2^20 + 1; 64 products of two residues stay below 2^53
ROOT = 3
CELLS = 1 << 17  # numbers in a transform at once
BATCH_BYTES = 1 << 20

Run = tuple[int, int, int]  # start, length, period


# ------------------------------------------------------------------------------------------------ exact transforms

def _mod(x: np.ndarray) -> np.ndarray:
    """Residues of whole numbers below 2^53; -1 may stand for the largest."""
    return x - np.floor(x / PRIME) * PRIME


@lru_cache(maxsize=32)
def _powers(size: int, rows: int, columns: int, inverse: bool, scale: int) -> np.ndarray:
    """w^(i j) for a root of unity w of order ``size``, times ``scale``."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    table = np.empty(size, np.int64)
    table[0] = 1
    for i in range(1, size):
        table[i] = table[i - 1] * root % PRIME
    return (table[np.outer(np.arange(rows), np.arange(columns)) % size] * scale % PRIME).astype(np.float64)


def _split(size: int) -> tuple[int, int]:
    high = 1 << ((size.bit_length() - 1) // 2)
    return size // high, high


def forward(x: np.ndarray) -> np.ndarray:
    """Transform of each row, in an order of its own that ``backward`` takes."""
    n = x.shape[1]
    if n <= 64:
        return _mod(x @ _powers(n, n, n, False, 1))
    a, b = _split(n)
    y = _mod(_powers(a, a, a, False, 1) @ x.reshape(-1, a, b))
    return _mod(_mod(y * _powers(n, a, b, False, 1)) @ _powers(b, b, b, False, 1)).reshape(-1, n)


def backward(x: np.ndarray) -> np.ndarray:
    n = x.shape[1]
    if n <= 64:
        return _mod(x @ _powers(n, n, n, True, pow(n, -1, PRIME)))
    a, b = _split(n)
    y = _mod(x.reshape(-1, a, b) @ _powers(b, b, b, True, 1))
    return _mod(_powers(a, a, a, True, pow(n, -1, PRIME)) @ _mod(y * _powers(n, a, b, True, 1))).reshape(-1, n)


def correlate(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """sum over j of blocks[:, j] * windows[:, d + j] modulo PRIME, for every d at which the block lies in the window."""
    size, width = windows.shape[1], blocks.shape[1]
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, size - width + 1:] = blocks[:, :0:-1]
    return backward(_mod(forward(windows) * forward(turned)))[:, :size - width + 1]


# ------------------------------------------------------------------------------------------------------- the search

class Words:
    """The words of several texts as numbers, one after another; equal words of a text have equal numbers."""

    def __init__(self, texts: list[list[str]]):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.codes = np.empty(int(sizes.sum()), np.int64)
        for start, text in zip(self.starts.tolist(), texts):
            seen: dict[str, int] = {}
            self.codes[start:start + len(text)] = [seen.setdefault(w, len(seen)) for w in text]
        # past the end all is 0: what is found there is sorted out
        padded = np.concatenate([self.codes % PRIME, np.zeros(4 * BLOCK + 4 * BASE, np.int64)])
        self.numbers = padded.astype(np.float64)
        self.squares = np.concatenate([[0], np.cumsum(padded * padded % PRIME)])

    def occurrences(self, opens: np.ndarray, first: np.ndarray, width: int, distances: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, place) wherever the ``width`` words from ``opens`` stand again at one of ``distances`` places from
        ``first``, as far as residues tell."""
        size = 1 << (width + distances - 2).bit_length()
        step, found, at = max(1, CELLS // size), [], np.arange(size)
        last = len(self.numbers) - 1
        for i in range(0, len(opens), step):
            o, f = opens[i:i + step, None], first[i:i + step, None]
            same = correlate(self.numbers[o + at[:width]], self.numbers[np.minimum(f + at, last)])[:, :distances]
            places = np.minimum(f + at[:distances], last - width)
            total = (self.squares[o + width] - self.squares[o] + self.squares[places + width] - self.squares[places]
                     - 2 * same.astype(np.int64))
            row, d = np.nonzero(total % PRIME == 0)
            found.append((opens[i + row], first[i + row] + d))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    def reach(self, at: int, distance: int, end: int) -> int:
        """First place from ``at`` on whose word differs from the one ``distance`` further; ``end`` bounds that one."""
        step, end = 64, end - distance
        while at < end:
            stop = min(at + step, end)
            differ = self.codes[at:stop] != self.codes[at + distance:stop + distance]
            i = int(differ.argmax())
            if differ[i]:
                return at + i
            at, step = stop, step * 2
        return end

    def reach_back(self, at: int, distance: int, start: int) -> int:
        """Smallest place down to ``start`` from which all words before ``at`` equal those ``distance`` further."""
        step = 64
        while at > start:
            low = max(at - step, start)
            differ = self.codes[low:at] != self.codes[low + distance:at + distance]
            i = int(differ[::-1].argmax())
            if differ[len(differ) - 1 - i]:
                return at - i
            at, step = low, step * 2
        return start

    def runs(self, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[list[Run]]:
        """The runs of each text, by start, then period."""
        found: list[dict[tuple[int, int], int]] = [{} for _ in self.starts]
        inside = np.full(len(self.codes), -1, np.int64)  # a run found so far that holds the word
        ends, periods = [], []
        scale = BASE
        while True:
            low = 1 if scale == BASE else scale
            open_ = np.flatnonzero(self.ends - self.starts >= max(shortest, repeats * low))
            if not len(open_):
                return [sorted(((s, e - s, q) for (s, e), q in f.items()), key=lambda r: (r[0], r[2])) for f in found]
            for text, start, place, width in self._candidates(open_, scale, low):
                if len(ends):
                    held = inside[start]
                    known = ((held >= 0) & (np.array(ends)[held] >= place + width)
                             & ((place - start) % np.array(periods)[held] == 0))
                    text, start, place = text[~known], start[~known], place[~known]
                for t, s, e, q in self._extend(text, start, place, width):
                    if e - s >= max(shortest, repeats * q) and (s - self.starts[t], e - self.starts[t]) not in found[t]:
                        found[t][s - int(self.starts[t]), e - int(self.starts[t])] = q
                        inside[s:e] = len(ends)
                        ends.append(e)
                        periods.append(q)
            scale *= 2

    def _candidates(self, texts: np.ndarray, scale: int, low: int):
        """(text, block, place, width) of the scale, one array each; windows of long scales come segment by segment."""
        width = min(scale, BLOCK)
        distances = 2 * scale - low if scale == BASE else width
        counts = np.maximum((self.ends[texts] - self.starts[texts] - width - low) // scale + 1, 0)
        text = np.repeat(texts, counts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        opens = self.starts[text] + nth * scale
        for segment in range(scale // width):
            first = opens + low + segment * width
            fits = first + width <= self.ends[text]
            o, p = self.occurrences(opens[fits], first[fits], width, distances)
            t = np.searchsorted(self.ends, o, "right")
            own = p + width <= self.ends[t]
            yield t[own], o[own], p[own], width

    def _extend(self, text: np.ndarray, opens: np.ndarray, places: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
        """(text, start, end, distance) of the maximal stretches around the candidates, ascending by distance."""
        away = places - opens
        order = np.lexsort((opens, text, away))
        text, opens, away = text[order], opens[order], away[order]
        edge = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (away[1:] != away[:-1])])) if len(text) else []
        for a, b in zip(edge, [*edge[1:], len(text)]):
            t, d, own, i = int(text[a]), int(away[a]), opens[a:b], 0
            start, end = int(self.starts[t]), int(self.ends[t])
            while i < len(own):
                o = int(own[i])
                right = self.reach(o, d, end)
                if right - o < width:  # equal by chance, modulo the prime
                    i += 1
                    continue
                yield t, self.reach_back(o, d, start), right + d, d
                i = int(np.searchsorted(own, right - width, "right"))  # blocks further on in the same stretch


def collapse(tokens: list[str], runs: list[Run]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return tokens
    edge = np.zeros(len(tokens) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [tokens[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]


# -------------------------------------------------------------------------------------------------------- in Spark

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, repeats: int = REPEATS,
                  rewrite: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of (doc_id, text): the runs of its words and the text without
    their repetitions, words joined by one space. ``rewrite`` changes the words of a row first. ``repeats`` is 3 at
    least: with less a run need not hold a block and its next occurrence."""
    if repeats < 3 or shortest < 3 * BASE:
        raise ValueError(f"runs of fewer than three periods or {3 * BASE} words are not found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BATCH_BYTES):
                texts = [words(t.as_py()) for t in part.column(1)]
                if rewrite:
                    texts = [rewrite(i.as_py(), t) for i, t in zip(part.column(0), texts)]
                found = Words(texts).runs(shortest, repeats)
                flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
                         [pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])),
                     pa.array([" ".join(collapse(t, r)) for t, r in zip(texts, found)], pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared as fractions; ties go to the smallest start, then period."""
    def order(a: Column, b: Column) -> Column:
        ahead = b.length * a.period - a.length * b.period
        by = F.when(ahead != 0, ahead).when(a.start != b.start, a.start - b.start).otherwise(a.period - b.period)
        return F.signum(by).cast("int")

    return F.get(F.array_sort(runs, order), F.lit(0))


def plant_period(doc_id: int | None, tokens: list[str]) -> list[str]:
    """Makes the tail of about every tenth text periodic, by its id alone; rows without id stay."""
    if doc_id is None or not tokens:
        return tokens
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return tokens
    n, g = len(tokens), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return tokens[:a] + [tokens[a + i % p] for i in range(n - a)]


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document (some made periodic first), the strongest one, and digests of runs and collapsed text."""
    found = periodic_runs(documents(spark, sf_dir), rewrite=plant_period)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = found.select("*", strongest(F.col("runs")).alias("best"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        sha_hex(listed).alias("runs_sha256"), sha_hex("collapsed").alias("collapsed_sha256"))

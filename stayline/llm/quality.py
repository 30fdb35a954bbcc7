"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

P(grade >= k) = sigmoid(z - threshold_k), z the sum of the weights of the hashed features a text has. One weight vector
is shared by all grades; the thresholds are ordered. Features are the presence of words, word shapes (letter case, digits,
signs) and word beginnings, hashed into 2^18 buckets. Buckets that a text sample shows to go with some grade enter the
model; the likelihood is climbed with Adam. All weights above 0 together make at most PRAISE: however long a text is, what
speaks for it cannot outweigh the few words that speak against it.

The model is fitted on at most FIT_ROWS labelled documents, those first in the hash order of their ids, in one task; only
the model reaches the driver. Scoring runs where the rows are and reads whole texts.

Grades here: 0 poor, 1 fair but toxic, 2 good. A document is kept when P(grade >= 2) is at least KEEP.

Defined results: of several labels of a document the lowest grade counts; labels with a null quality or id, or without a
document, are left out, a null toxic mark counts as 0; a text without words (null included) has z = -inf, so probabilities
0, and is not kept; without usable labels every text with words is kept (probabilities 1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import Memo, documents, kept_alone, list_array, slices, table, words
from stayline.llm.registry import query

BITS = 18
FIT_ROWS = 16_000  # bound of the labelled sample
LEAST_ROWS = 10  # sample documents a bucket must occur in
ASSOCIATION = 5.0  # standard errors by which it must go with a grade
PENALTY, RATE, ROUNDS = 1e-3, 0.1, 150
PRAISE = 8.0  # bound of the sum of all weights above 0
PART = 500_000  # features the fit works on at once
KEEP = 0.7  # with PRAISE chosen on held-out labels, for clean texts kept and toxic ones caught
CERTAIN = 50.0


# ------------------------------------------------------------------------------------------------------- features

def shape(word: str) -> str:
    """Kinds of characters in order, without repeats."""
    out, last = [], ""
    for c in word:
        kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
        if kind != last:
            out.append(kind)
            last = kind
    return "".join(out)


def buckets(word: str) -> tuple[int, int, int]:
    plain = word.lower().strip('.,;:!?"()')
    return tuple(xxhash.xxh32_intdigest(x.encode("utf-8", "surrogatepass")) >> (32 - BITS)
                 for x in (f"w:{plain}", f"s:{shape(word)}", f"p:{plain[:5]}"))


def features(text: str | None, memo: dict) -> np.ndarray:
    found: set[int] = set()
    for word in set(words(text)):
        found.update(memo[word])
    return np.sort(np.fromiter(found, np.int32, len(found)))


# -------------------------------------------------------------------------------------------------------- fitting

def graded(labels: DataFrame) -> DataFrame:
    """(of_doc, grade) from (doc_id, quality, toxic)."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return (labels.where("doc_id is not null and quality is not null")
            .groupBy(F.col("doc_id").alias("of_doc")).agg(F.min(grade).alias("grade")))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -CERTAIN, CERTAIN)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets, their weights, and the ordered thresholds."""
    n = len(rows)
    cuts = np.arange(1, n_grades)
    if n == 0:
        return np.empty(0, np.int32), np.empty(0), np.full(len(cuts), -CERTAIN)
    size = 1 << BITS
    held = np.zeros((n_grades, size), np.int64)  # texts of each grade that have a bucket
    for row, grade in zip(rows, grades.tolist()):  # row by row: an array over all features of all texts takes too much memory
        np.add.at(held[grade], row, 1)
    count = held.sum(0)
    share = count / n
    strength = np.zeros(size)
    for k in cuts:
        above = (grades >= k).astype(float)
        var = above.var() * n * share * (1 - share)
        moved = held[k:].sum(0) - above.mean() * count
        strength = np.maximum(strength, np.abs(moved) / np.sqrt(np.where(var > 0, var, np.inf)))
    chosen = np.flatnonzero((count >= LEAST_ROWS) & (strength >= ASSOCIATION)).astype(np.int32)
    place = np.full(size, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    at, col = (np.empty(count[chosen].sum(), np.int32) for _ in range(2))
    end = 0
    for i, row in enumerate(rows):
        inside = place[row]
        inside = inside[inside >= 0]
        at[end:end + len(inside)], col[end:end + len(inside)] = i, inside
        end += len(inside)
    del held, count, share, strength, place
    parts = [(at[i:i + PART], col[i:i + PART]) for i in range(0, end, PART)]
    values = np.concatenate([np.zeros(len(chosen)), np.linspace(-2, -1, len(cuts))])
    first, second = np.zeros_like(values), np.zeros_like(values)
    lines = np.arange(n)
    for step in range(1, ROUNDS + 1):
        weight, limit = values[:len(chosen)], values[len(chosen):]
        z = np.zeros(n)
        for line, place in parts:
            np.add.at(z, line.astype(np.intp), weight[place])
        tail = np.ones((n, n_grades + 1))
        tail[:, 1:-1] = sigmoid(z[:, None] - limit[None, :])
        tail[:, -1] = 0
        low, high = tail[lines, grades], tail[lines, grades + 1]
        chance = np.maximum(low - high, 1e-9)
        by_z = 1 - low - high
        by_limit = np.zeros((n, n_grades + 1))
        by_limit[lines, grades] -= low * (1 - low) / chance
        by_limit[lines, grades + 1] += high * (1 - high) / chance
        by_weight = np.zeros(len(chosen))
        for line, place in parts:
            np.add.at(by_weight, place.astype(np.intp), by_z[line])
        slope = np.concatenate([by_weight / n - PENALTY * weight, by_limit[:, 1:-1].mean(0)])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope ** 2
        values = values + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        weight, values[len(chosen):] = values[:len(chosen)], np.maximum.accumulate(values[len(chosen):])
        weight[weight > 0] *= min(1.0, PRAISE / max(weight[weight > 0].sum(), 1e-9))
    return chosen, values[:len(chosen)], values[len(chosen):]


class Model:
    """Buckets with weights, and thresholds; small enough to travel inside a function."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, limits: np.ndarray):
        self.chosen, self.weights, self.limits = np.asarray(chosen, np.int32), np.asarray(weights, float), np.asarray(limits, float)

    def scores(self, text: Column) -> Column:
        """z of each text."""
        packed = (self.chosen.tobytes(), self.weights.tobytes())

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            known, memo = kept_alone(_scorer, *packed)
            return pa.array([_score(t.as_py(), known, memo) for t in texts], pa.float64())

        return score(text)

    def tails(self, z: Column) -> list[Column]:
        """P(grade >= k) for k = 1, 2, ..."""
        def tail(limit: float) -> Column:
            return F.when(z == float("-inf"), 0.0).otherwise(1 / (1 + F.exp(F.lit(float(limit)) - z)))

        return [tail(limit) for limit in self.limits]


def _scorer(chosen: bytes, weights: bytes) -> tuple[dict[int, float], Memo]:
    """Weights by bucket, and of each word met the buckets that have one."""
    known = dict(zip(np.frombuffer(chosen, np.int32).tolist(), np.frombuffer(weights, float).tolist()))
    return known, Memo(lambda word: tuple(b for b in buckets(word) if b in known), 200_000)


def _score(text: str | None, known: dict[int, float], memo: Memo) -> float:
    distinct = set(words(text))
    if not distinct:
        return float("-inf")
    found: set[int] = set()
    found.update(*map(memo.__getitem__, distinct))
    return sum(map(known.__getitem__, sorted(found)), 0.0)


def fit_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents of (doc_id, text)."""
    order = F.xxhash64("of_doc")
    sample = F.broadcast(graded(labels).orderBy(order, "of_doc").limit(rows))  # bounded by ``rows``

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(buckets, 50_000)  # a word's buckets take some hundred bytes
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                found = [features(t.as_py(), memo) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), list_array(found, pa.int32()), part.column(2)],
                                                 ["doc_id", "found", "grade"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_, ids, grades = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            grades += batch.column(2).to_pylist()
            rows_ += [np.asarray(x.values) for x in batch.column(1)]
        order_ = np.argsort(np.array(ids, np.int64), kind="stable")  # the fit does not depend on the order of arrival
        model = fit([rows_[i] for i in order_], np.array(grades, np.int64)[order_])
        yield pa.RecordBatch.from_arrays(
            [pa.array([model[0].tolist()], pa.list_(pa.int32()))] + [pa.array([m.tolist()], pa.list_(pa.float64())) for m in model[1:]],
            ["chosen", "weights", "limits"])

    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
             .join(sample, F.col("doc_id") == F.col("of_doc"))
             .select("doc_id", "text", "grade").mapInArrow(extract, "doc_id long, found array<int>, grade int"))
    model = (found.repartition(1).mapInArrow(learn, "chosen array<int>, weights array<double>, limits array<double>")
             .first())  # one row
    return Model(model["chosen"], model["weights"], model["limits"])


# ------------------------------------------------------------------------------------------------------- selection

def grade_documents(docs: DataFrame, model: Model, text: str = "text", keep: float = KEEP) -> DataFrame:
    """(row, z, p_fair, p_good, expected_grade, keep) for every row of ``docs``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       model.scores(F.col(f"`{text}`")).alias("z"))
    fair, good = model.tails(F.col("z"))
    return rows.select("row", "z", fair.alias("p_fair"), good.alias("p_good"), (fair + good).alias("expected_grade"),
                       (good >= keep).alias("keep"))


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of every document, and whether it is kept."""
    docs = documents(spark, sf_dir)
    model = fit_model(docs, table(spark, sf_dir, "labels"))
    return grade_documents(docs.select("doc_id", "text"), model).select(
        "row.doc_id", "z", "p_fair", "p_good", "expected_grade", "keep")

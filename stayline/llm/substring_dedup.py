"""Substring dedup by seed and extend.

A window is WINDOW consecutive words of one document. Words covered by a window whose words also stand, in this order,
in a document with a smaller id are removed; windows are judged on the input.

Seeds: hashes of GRAM words, winnowed, so that every window has an anchor that depends on its words alone (the smallest
gram hash in it). Anchors of one document only cannot lie in a repeat. Occurrences meet on shared anchors: every window
that has such an anchor as its own is led to its source, the first place in the smallest document with the same anchor and
words (windows are compared by their hashes).

Extension: windows are followed to both sides along the diagonal, window after window of a text beside window after window
of one source, as far as words agree. What comes of it are spans, ``repeat_spans``: matches of WINDOW words or more that
cannot be made longer with this source as the smallest. Where a smaller document takes over, its own span begins, and the
two overlap by a window less a word. A repeat shorter than a window gives none. Words inside spans are cut.

What crosses a shuffle is hashes: anchors, combined per map task, and the windows around shared ones. Texts move only for
documents that have seeds. Documents with equal words stand in for each other: only the smallest id is searched, the
others are all repeat. No pairs of documents are formed, so a passage in a third of all documents costs a row per
occurrence, combined before it is shuffled.

Defined results: a null or empty text has no words; fewer words than a window are never removed; equal windows inside one
document, or in rows with the same id, are not repeats of a smaller id; null ids come after all others. Of equal rows
each is reported; their spans are listed once. The place in a source is that in one of its rows, should several share
the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import Memo, as_long, documents, hash_word, mix, window_hashes, word_hashes, words
from stayline.llm.registry import query
from stayline.llm.text_keys import doc_value, is_present, keyed, presence_map, searched_texts, written

WINDOW = 13
GRAM = 6  # words of a seed; shorter ones are shared by chance more often
NOTHING = hashlib.sha256(b"").hexdigest()


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """The anchor of every window of a text: the smallest gram hash inside it."""
    grams = window_hashes(hashes, gram)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    least = grams[:n].copy()
    for i in range(1, window - gram + 1):
        np.minimum(least, grams[i:i + n], out=least)
    return least


_HASHES = Memo(hash_word)  # per Python worker


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, [word_hashes(words(t.as_py()), _HASHES) for t in batch.column(batch.schema.get_field_index("text"))]


def anchor_rows(rows: DataFrame, window: int, gram: int, wanted=None) -> DataFrame:
    """(anchor, doc, tkey): the distinct anchors of each text; of all, or of those a presence map lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _each(batches):
            found = [np.unique(anchors(h, window, gram)) for h in texts]
            if wanted is not None:
                found = [f[is_present(wanted.value, f)] for f in found]
            counts = [len(f) for f in found]
            flat = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [as_long(flat), *[pa.array(np.repeat(batch.column(i).to_numpy(), counts)) for i in (0, 1)]],
                ["anchor", "doc", "tkey"])

    return rows.mapInArrow(run, "anchor long, doc long, tkey long")


def window_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(h1, h2, doc, row, pos, again) of the windows of (doc, row, text, seeds) whose anchor is a seed; ``again`` if the
    text had the window before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _each(batches):
            parts, counts, again = [], [], []
            for hashes, seeds in zip(texts, batch.column(3)):
                own = np.isin(anchors(hashes, window, gram), np.asarray(seeds.values).view(np.uint64))
                at = np.flatnonzero(own)
                counts.append(len(at))
                parts.append((window_hashes(hashes, window, 2)[at], window_hashes(mix(hashes), window, 3)[at], at))
                later = np.ones(len(at), bool)
                later[np.unique(parts[-1][0], return_index=True)[1]] = False
                again.append(later)
            h1, h2, at = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.uint64),) * 3
            yield pa.RecordBatch.from_arrays(
                [as_long(h1), pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                 *[pa.array(np.repeat(batch.column(i).to_numpy(), counts)) for i in (0, 1)], pa.array(at.astype(np.int32)),
                 pa.array(np.concatenate(again) if again else np.empty(0, bool))],
                ["h1", "h2", "doc", "row", "pos", "again"])

    return rows.select("doc", "row", "text", "seeds").mapInArrow(run, "h1 long, h2 int, doc long, row long, pos int, again boolean")


def extended(repeats: DataFrame, window: int) -> DataFrame:
    """(row, start, end, source, source_start) of (row, pos, low, low_pos): windows of a text joined along the diagonal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the run that may go on in the next batch: row, start, source, source_start, its last window
        for batch in batches:
            row, pos, low, low_pos = (batch.column(i).to_numpy() for i in range(4))
            if last is not None:
                end = last[4]
                row, pos, low, low_pos = (np.r_[v, x] for v, x in zip(
                    (last[0], end, last[2], last[3] + end - last[1]), (row, pos, low, low_pos)))
            if not len(row):
                continue
            twice = np.r_[False, (row[1:] == row[:-1]) & (pos[1:] == pos[:-1])]  # equal rows share their number
            row, pos, low, low_pos = (x[~twice] for x in (row, pos, low, low_pos))
            new = np.r_[True, (row[1:] != row[:-1]) | (low[1:] != low[:-1]) | (pos[1:] != pos[:-1] + 1)
                        | (low_pos[1:] != low_pos[:-1] + 1)]
            first = np.flatnonzero(new)
            ends = pos[np.r_[first[1:], len(pos)] - 1]
            runs = [x[first] for x in (row, pos, low, low_pos)]
            if last is not None:  # the first run began in an earlier batch
                runs[1][0], runs[3][0] = last[1], last[3]
            last = (*[int(x[-1]) for x in runs], int(ends[-1]))
            yield _spans(runs[0][:-1], runs[1][:-1], ends[:-1], runs[2][:-1], runs[3][:-1])
        if last is not None:
            yield _spans(*[np.array([last[i]]) for i in (0, 1, 4, 2, 3)])

    def _spans(row, start, end, source, source_start) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), pa.array(start.astype(np.int32)), pa.array((end + window).astype(np.int32)),
             pa.array(source, pa.int64()), pa.array(source_start.astype(np.int32))],
            ["row", "start", "end", "source", "source_start"])

    return repeats.select("row", "pos", "low", "low_pos").repartition("row").sortWithinPartitions("row", "pos").mapInArrow(
        run, "row long, start int, end int, source long, source_start int")


def cut_rows(rows: DataFrame) -> DataFrame:
    """(doc, tkey, n_removed, kept, kept_sha256) of (doc, tkey, text, spans): words outside the spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for text, spans in zip(batch.column(2), batch.column(3)):
                tokens = words(text.as_py())
                edge = np.zeros(len(tokens) + 1, np.int64)
                start, end = (np.asarray(x) for x in spans.values.flatten())
                np.add.at(edge, start, 1)
                np.add.at(edge, end, -1)
                stay = np.cumsum(edge)[:-1] == 0
                removed.append(len(tokens) - int(stay.sum()))
                kept.append(" ".join([tokens[i] for i in np.flatnonzero(stay).tolist()]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int32()), pa.array(kept, pa.string()),
                 pa.array([hashlib.sha256(k.encode("utf-8", "surrogatepass")).hexdigest() for k in kept], pa.string())],
                ["doc", "tkey", "n_removed", "kept", "kept_sha256"])

    return rows.select("doc", "tkey", "text", "spans").mapInArrow(
        run, "doc long, tkey long, n_removed int, kept string, kept_sha256 string")


def repeat_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, texts, spans): the word table of all rows with ``first``, the smallest id with the same words; the rows
    that may have seeds as (doc, tkey, text); and (doc, tkey, start, end, source, source_start), matches of the words
    [start, end) with a smaller document. Rows with a smaller ``first`` are copies as a whole and have no spans."""
    spark = docs.sparkSession
    table, searched = searched_texts(keyed(docs))
    # seeds
    shared = written(anchor_rows(searched, window, gram).groupBy("anchor")
                     .agg(F.count("*").alias("texts")).where("texts > 1").select("anchor"), "anchors")
    wanted = spark.sparkContext.broadcast(presence_map(shared, "anchor"))
    seeds = written(anchor_rows(searched, window, gram, wanted).join(shared, "anchor", "left_semi")
                    .groupBy("doc", "tkey").agg(F.collect_set("anchor").alias("seeds"))
                    .withColumn("row", F.monotonically_increasing_id()), "seeds")  # short row numbers, fixed by writing
    # extension
    place = F.xxhash64("doc", "tkey")
    near = spark.sparkContext.broadcast(presence_map(seeds.select(place.alias("at")), "at"))

    @F.pandas_udf("boolean")
    def maybe(at: pd.Series) -> pd.Series:
        return pd.Series(is_present(near.value, at.to_numpy().view(np.uint64)))

    moved = searched.where(maybe(place))
    seeded = moved.join(seeds, ["doc", "tkey"])
    found = written(window_rows(seeded, window, gram), "windows")
    first_at = (found.where("not again").groupBy("h1", "h2")
                .agg(F.min("doc").alias("low"), F.min_by("pos", "doc").alias("low_pos"), F.count("*").alias("times"))
                .where("times > 1").select("h1", "h2", "low", "low_pos"))
    repeats = found.join(first_at, ["h1", "h2"]).where("doc > low")
    spans = written(extended(repeats, window).join(seeds.select("row", "doc", "tkey"), "row").drop("row"), "spans")
    return table, moved, spans.select("doc", "tkey", "start", "end", "source", "source_start")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(words, cut): the word table of ``repeat_spans`` and the rows of ``cut_rows`` for texts with spans. Rows with a
    smaller ``first`` lose all words."""
    table, texts, spans = repeat_spans(docs, window, gram)
    listed = spans.groupBy("doc", "tkey").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return table, cut_rows(texts.join(listed, ["doc", "tkey"]))


OP8_SQL = rf"""
with w as (select row_number() over () r, coalesce(doc_id, 9223372036854775807) doc, doc_id,
             coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) ws from documents),
p as (select r, doc, unnest(range(1, len(ws) - {WINDOW - 2})) i from w),
g as (select p.r, p.doc, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') gram from p join w using (r)),
f as (select gram, min(doc) low from g group by gram having min(doc) < max(doc)),
h as (select distinct r, unnest(range(i, i + {WINDOW})) j from g join f using (gram) where doc > low),
c as (select r, list(j) js from h group by r),
k as (select doc_id, ws, list_filter(ws, lambda x, j: not coalesce(list_contains(js, j), false)) kept from w left join c using (r))
select doc_id, cast(len(ws) as int) n_words, cast(len(ws) - len(kept) as int) n_removed,
  sha256(array_to_string(kept, ' ')) kept_sha256 from k
"""


def report(table: DataFrame, cut: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row, from the two tables of ``remove_repeats``."""
    cut = cut.select("doc", "tkey", "n_removed", F.col("kept_sha256").alias("cut_sha256")).dropDuplicates(["doc", "tkey"])
    copy = (F.col("doc") > F.col("first")) & (F.col("n_words") >= window)
    return table.join(cut, ["doc", "tkey"], "left").select(
        doc_value(F.col("doc")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).otherwise(F.coalesce("cut_sha256", "words_sha256")).alias("kept_sha256"))


@query("op8_substring_dedup", OP8_SQL)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words, how many repeat a smaller document, and the digest of the rest."""
    return report(*remove_repeats(documents(spark, sf_dir).select("doc_id", "text")))

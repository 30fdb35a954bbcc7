"""From raw documents to token ids, in five stages.

Every stage but the last takes and returns rows with the columns of documents; what it decides takes effect on all rows
its predecessor kept:

1. quality classifier: documents that it rejects go;
2. line dedup: boilerplate lines of a source go from its texts, n_chars follows;
3. MinHash near-dedup: one document of each class stays, the one with the smallest id;
4. mixing: every document stands as often as the mix takes it;
5. SentencePiece: the ids of every document, and what they decode to.

Defined results: an empty table stays empty through all stages; null texts count as without words and are rejected by the
first stage; further columns of the input are carried through to the last stage, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import dart_minhash, line_dedup, mixing, quality, sentencepiece_fst
from stayline.llm.common import documents, small_batches, table
from stayline.llm.text_keys import doc_key, written
from stayline.llm.token_files import vocabulary_path

COPIES = 1_000_000  # ids that may be broadcast
STRETCHES = 200_000  # solved by a worker and kept: workers hold what earlier stages remember too


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, fitted on the labels, keeps."""
    with small_batches(spark):
        model = quality.fit_model(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
        return written(quality.grade_documents(docs, model).where("keep").select("row.*"), "good")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source."""
    cut = line_dedup.drop_boilerplate(docs)
    new = {"text": F.col("kept"), "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(
        F.col("row.n_chars")).cast(dict(docs.dtypes)["n_chars"])}
    return cut.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; of rows with one id and text one. Ids need not be there or differ."""
    with small_batches(spark):
        found = written(dart_minhash.near_duplicates(docs.select("doc_id", "text")).select("doc", "tkey", "root"), "classes")
    stays = F.struct("doc", "tkey")
    best = found.groupBy("root").agg(F.min(stays).alias("best"))
    marked = found.join(best, "root").select("doc", "tkey", (stays == F.col("best")).alias("stays"))
    gone = written(marked.where("not stays").select(F.col("doc").alias("gone_doc"), F.col("tkey").alias("gone_key")).distinct(), "gone")
    twice = not marked.where("stays").groupBy("doc", "tkey").count().where("count > 1").isEmpty()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = (doc_key(F.col("row.doc_id")) == F.col("gone_doc")) & (F.xxhash64("row.text") == F.col("gone_key"))
    kept = rows.join(F.broadcast(gone) if gone.count() <= COPIES else gone, same, "left_anti")
    if twice:
        kept = kept.groupBy(doc_key(F.col("row.doc_id")).alias("doc"), F.xxhash64("row.text").alias("tkey")).agg(
            F.first("row").alias("row"))
    return kept.select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    labels = table(spark, sf_dir, "labels")
    sizes = written(mixing.sized(docs.select("doc_id", "source", "text"), labels), "sizes")
    plan, bounds = mixing.plan_mix(sizes)
    copies = mixing.with_copies(sizes, plan, bounds).groupBy("doc_id", "tie").agg(F.max("copies").alias("copies"))
    times = written(copies.where("copies > 0").select(doc_key(F.col("doc_id")).alias("times_doc"), F.col("tie").alias("times_key"),
                                                      F.col("copies").cast("int")), "times")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = (doc_key(F.col("row.doc_id")) == F.col("times_doc")) & (F.xxhash64("row.text") == F.col("times_key"))
    return (rows.join(F.broadcast(times) if times.count() <= COPIES else times, same)
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, decoded_sha256, round_trip of every document of the mix."""
    with small_batches(spark):
        return written(sentencepiece_fst.encode_pieces(docs, vocabulary_path("piece_bpe_32k.model"), stretches=STRETCHES), "pieces")


STAGES = [("quality", keep_good), ("lines", drop_lines), ("near copies", drop_near_copies), ("mix", mix),
          ("sentencepiece", encode)]
ORACLE_SQL = None  # a fitted classifier and a tokenizer are beyond SQL; tests compare each stage with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written as Parquet in the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

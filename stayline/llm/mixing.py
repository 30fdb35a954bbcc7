"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share 150% of all words. A target stops at twice
its source's size and the excess is shared again by weight. Of its target a source first gives complete epochs (every
document once per epoch); the rest is a weighted draw without replacement: document i gets the exponential key
-ln(u_i) / w_i, keys are sorted within the source and sizes are summed up to the word budget. The document that crosses
the budget is taken when that comes nearer to it.

u_i comes from a digest of the document's id, so reruns agree and no random state is kept. Rows are never collected per
source: totals per (source, key bucket) show in which bucket the budget runs out, and only that bucket is sorted.

Defined results: a null or empty text has size 0 and takes 0 words; a row without id draws by its text; equal rows are
numbered and draw by their numbers, so they are taken one by one and are interchangeable; other rows with one id share a
key and are ordered by size and text digest; a weight of null counts as 1, a weight of 0 or less as never
drawn (complete epochs still hold it); an empty table gives no rows. A source without words has target 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stayline.llm.common import WORD, documents, settle_small, table
from stayline.llm.registry import query
from stayline.plans.durable import cut_lineage
from stayline.plans.ordered import global_rank, range_bounds, with_buckets
from stayline.plans.small import same_keys

# Fixed values of the mix
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
# What a label says about a document's weight in the draw
GOOD, PLAIN, POOR = 1.5, 1.0, 0.5
SEED = "mix"
BUCKETS = 1024


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1), from 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def sampling_key(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    w = F.coalesce(weight, F.lit(1.0))
    return F.when(w > 0, -F.log(draw(doc_id, seed)) / w).otherwise(F.lit(float("inf")))


def quality_weights(labels: DataFrame) -> DataFrame:
    """(of_doc, weight): one row per labelled document; the worst of several labels counts."""
    poor = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("of_doc")).agg(
        F.when(F.max(F.when(poor, 1).otherwise(0)) == 1, POOR).when(F.max("quality") == 1, GOOD).otherwise(PLAIN)
        .alias("weight"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target, epochs, rest) from (source, source_size).

    The level at which every source has min(most * size, level * weight) is found by sharing the excess again: one
    aggregate over the sources per round, until no further source is full.
    """
    placed = global_rank(sizes.withColumn("is_null", F.col("source").isNull()), ["is_null", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = cut_lineage(placed.select("source", "source_size", weight.alias("w"),
                                     (F.lit(most) * F.col("source_size")).alias("top")))
    level, budget = 0.0, share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    while budget:
        full = F.col("top") <= F.lit(level) * F.col("w")
        used, left = rows.agg(F.sum(F.when(full, F.col("top")).otherwise(0.0)),
                              F.sum(F.when(full, 0.0).otherwise(F.col("w")))).first()
        if not left or (budget - used) / left == level:
            break
        level = (budget - used) / left
    target = F.least("top", F.lit(level) * F.col("w"))
    epochs = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("long")
    return rows.select("source", "source_size", target.alias("target"), epochs.alias("epochs"),
                       (target - epochs * F.col("source_size")).alias("rest"))


def plan_mix(rows: DataFrame, buckets: int = BUCKETS, **options) -> tuple[DataFrame, list[list[float]]]:
    """From (doc_id, source, size, key, tie): per source the target and where its draw ends, and the bucket edges."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, **options))
    bounds = range_bounds(rows.where(F.col("key") < float("inf")), ["key"], buckets)
    cells = with_buckets(rows, ["key"], bounds, "_bucket")
    upto = W.partitionBy("source").orderBy("key_bucket").rowsBetween(W.unboundedPreceding, 0)
    totals = (cells.groupBy("source", "key_bucket").agg(F.sum("size").alias("held"))
              .withColumn("before", F.sum("held").over(upto) - F.col("held")))
    of = targets.select(F.col("source").alias("of"), "rest")
    edge = (totals.join(settle_small(of), F.col("source").eqNullSafe(F.col("of")))
            .where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("held")))
            .select("of", "rest", "before", F.col("key_bucket").alias("cut_bucket")))
    edge = settle_small(edge)
    inside = W.partitionBy("source").orderBy("key", "doc_id", "size", "tie").rowsBetween(W.unboundedPreceding, -1)
    near = (cells.join(edge, F.col("source").eqNullSafe(F.col("of")) & (F.col("key_bucket") == F.col("cut_bucket")))
            .withColumn("so_far", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))))
    room = F.col("rest") - F.col("so_far")
    last = (near.where((room > 0) & (F.col("size") <= 2 * room)).groupBy("source")
            .agg(F.max(F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "size", "tie"))
                 .alias("cut")))
    plan = (targets.join(edge.select("of", "cut_bucket"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
            .join(last.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left"))
    return settle_small(plan.select(F.col("source").alias("of"), "source_size", "target", "epochs", "cut_bucket", "cut")), bounds


def with_copies(rows: DataFrame, plan: DataFrame, bounds: list[list[float]]) -> DataFrame:
    """Add source_size, target and copies to rows with (doc_id, source, size, key, tie); rows are not shuffled while
    the plan, one row per source, is small enough to broadcast."""
    own = F.struct("key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_id"), "size", "tie")
    drawn = (F.col("key_bucket") < F.col("cut_bucket")) | ((F.col("key_bucket") == F.col("cut_bucket")) & (own <= F.col("cut")))
    return (with_buckets(rows, ["key"], bounds, "_bucket").join(plan, F.col("source").eqNullSafe(F.col("of")))
            .withColumn("copies", F.col("epochs") + F.coalesce(drawn, F.lit(False)).cast("long"))
            .select(*rows.columns, "source_size", "target", "copies"))


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``nth``, 0, 1, ... among rows with equal (doc_id, source, size, tie).

    Equal rows are counted per task first and numbered inside it, so a row that a third of the table repeats is spread.
    """
    same = ["doc_id", "source", "size", "tie"]
    rows = cut_lineage(rows.withColumn("part", F.spark_partition_id()))
    counts = rows.groupBy(*same, "part").agg(F.count("*").alias("n"))
    often = cut_lineage(counts.groupBy(*same).agg(F.sum("n").alias("times")).where("times > 1").drop("times"))
    if often.isEmpty():
        return rows.withColumn("nth", F.lit(0).cast("long")).drop("part")
    equal = same_keys([F.col(c) for c in same], [F.col(f"of_{c}") for c in same])
    often = often.select(*[F.col(c).alias(f"of_{c}") for c in same])
    earlier = W.partitionBy(*same).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = (counts.join(often, equal, "left_semi")
              .select(*[F.col(c).alias(f"of_{c}") for c in same], F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")))
    inside = W.partitionBy(*same, "part").orderBy("part")
    repeated = (rows.withColumn("at", F.row_number().over(inside) - 1)
                .join(starts, equal & (F.col("part") == F.col("of_part"))).select(*same, (F.col("start") + F.col("at")).alias("nth")))
    return rows.join(often, equal, "left_anti").select(*same, F.lit(0).cast("long").alias("nth")).unionByName(repeated)


def drawn_by(doc_id: Column, digest: Column, nth: Column) -> Column:
    """What a row's draw follows from: its id, or its text without one, and its number among equal rows."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("null:"), digest.cast("string")))
    return F.when(nth > 0, F.concat(name, F.lit("#"), nth.cast("string"))).otherwise(name)


def sized(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, tie) of documents; labels, one row per document, are joined by id."""
    rows = numbered(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")))
    weights = quality_weights(labels)
    name = drawn_by(F.col("doc_id"), F.col("tie"), F.col("nth"))
    return (rows.join(weights, F.col("doc_id") == F.col("of_doc"), "left")
            .select("doc_id", "source", "size", sampling_key(name, F.col("weight")).alias("key"), "tie"))


def mix_sources(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, source, size, key, tie, source_size, target, copies) for every document."""
    rows = cut_lineage(sized(docs, labels))
    return with_copies(rows, *plan_mix(rows))


OP9_SQL = rf"""
with w as (select doc_id, case when max(case when quality = 0 or toxic = 1 then 1 else 0 end) = 1 then {POOR}
                               when max(quality) = 1 then {GOOD} else {PLAIN} end w from labels group by doc_id),
d as (select d.doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) size,
        -ln((cast('0x' || substr(md5('{SEED}:' || d.doc_id), 1, 13) as bigint) + 0.5) / 4503599627370496.0::double)
          / coalesce(w.w, 1.0)::double k
      from documents d left join w on d.doc_id = w.doc_id),
s as (select source, sum(size)::bigint source_size, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3]::double sw
      from d group by source),
r as (select *, {MOST}::double * source_size top, {SHARE}::double * sum(source_size) over () budget,
        coalesce(sum({MOST}::double * source_size) over o, 0) full_before, sum(sw) over () - coalesce(sum(sw) over o, 0) open_weight
      from s window o as (order by {MOST}::double * source_size / sw, source rows between unbounded preceding and 1 preceding)),
l as (select max((budget - full_before) / open_weight) filter (top / sw >= (budget - full_before) / open_weight) lev from r),
t as (select source, source_size, least(top, coalesce(lev, 0) * sw) target from r, l),
e as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end epochs from t),
c as (select d.doc_id, d.k, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size rest,
        coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id rows between unbounded preceding and 1 preceding), 0) so_far
      from d join e on d.source is not distinct from e.source)
select doc_id, size::bigint size, source_size, target,
  (size * (epochs + case when rest - so_far > 0 and size <= 2 * (rest - so_far) then 1 else 0 end))::bigint taken
from c
"""


@query("op9_mix_sources", OP9_SQL)
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, in words."""
    mixed = mix_sources(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

"""MinHash near-dedup with DartMinHash.

A text is the weighted set of its SHINGLE-word shingles, a shingle's weight being how often it stands there. Darts fall
on the half-plane (weight axis of a shingle x rank) as a Poisson process that depends on the shingle alone; a text sees
the darts inside its regions. Each dart has a random coordinate, and the earliest dart of every coordinate is the
signature. Two signatures agree in a coordinate with the probability of the texts' weighted Jaccard similarity. Only
about k (ln k + 4) darts are thrown per text however many shingles it has; more when a coordinate stayed empty.

Signatures are cut into bands; texts that share a band meet in a bucket. At similarity 0.8 a pair misses all buckets with
probability 1e-5. Inside a bucket nobody is paired with everybody: all are compared with a leader (the one that meets
most others in its buckets), then those outside the class that most of the bucket is in with leaders of their own, as
long as these link a share of them. Who is left is compared with members of other classes by what sets them apart from
the first leader: two texts that are similar, but not both similar to the leader, differ from it in the same elements, so
only members that share a rare one of these differences meet (see ``apart``). Every comparison is exact, on whole sets. So
no pair that met in a bucket and reaches the threshold ends in two classes.

Texts with equal words stand in for each other and are searched once.

Defined results: a text of fewer words than a shingle is one shingle; rows without words (null, empty) are copies of each
other; null ids come after all others, a class of null ids only has a null class id; an empty table gives no rows. Classes
are connected components, their id is the smallest doc_id in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import Memo, as_long, documents, hash_word, kept_alone, list_array, settle_small, slices, window_hashes, word_hashes, words
from stayline.llm.registry import query
from stayline.llm.text_keys import doc_value, is_present, keyed, mixed, node_of, presence_map, searched_texts, word_digest, written

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 38, 6
PROGRESS = 0.1  # share of those it is compared with that a leader must link for its bucket to get another one
FEW = 50  # members of a bucket that need no further leader
EPS = 1e-9
UNITS = 100_000  # darts regions worked on at once

HASHES = 200_000  # of words, kept by a Python worker


# ------------------------------------------------------------------------------------------------------ signatures

def shingles(tokens: list[str], width: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles, repeats included, sorted."""
    if not tokens:
        return np.empty(0, np.uint64)
    width = min(width, len(tokens))
    return np.sort(window_hashes(word_hashes(tokens, kept_alone(Memo, hash_word, HASHES)), width, width))


def cells(sorted_hashes: np.ndarray) -> np.ndarray:
    """One key per unit of weight: the n-th occurrence of a hash is a cell of its own."""
    n = len(sorted_hashes)
    if not n:
        return sorted_hashes
    at = np.arange(n)
    begin = np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]])
    return mixed(sorted_hashes, at - np.maximum.accumulate(np.where(begin, at, 0)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def dart_minhash(regions: list[np.ndarray], k: int = BANDS * ROWS, parts: list[np.ndarray] | None = None) -> np.ndarray:
    """Signatures, one row of k values per region. ``regions`` hold cell keys, ``parts`` the share of each cell that is
    inside the region (all of it unless given). Empty regions give zeros."""
    out = np.zeros((len(regions), k), np.uint64)
    sizes = np.array([len(r) if parts is None else float(p.sum()) for r, p in zip(regions, parts or regions)])
    start = 0
    while start < len(regions):
        stop, units = start, 0
        while stop < len(regions) and (stop == start or units < UNITS):
            units += len(regions[stop]) * max(1, ceil(k * (log(k) + 4) / max(sizes[stop], 1e-9)))
            stop += 1
        _throw(regions[start:stop], sizes[start:stop], None if parts is None else parts[start:stop], out[start:stop])
        start = stop
    return out


def _throw(regions, sizes, parts, out) -> None:
    n, k = out.shape
    low, high = np.zeros(n), k * (log(k) + 4) / np.maximum(sizes, 1e-9)
    filled = np.zeros((n, k), bool)
    filled[sizes <= 0] = True
    while not filled.all():
        todo = np.flatnonzero(~filled.all(axis=1))
        key = np.concatenate([regions[i] for i in todo])
        owner = np.repeat(todo, [len(regions[i]) for i in todo])
        room = None if parts is None else np.concatenate([parts[i] for i in todo])
        first = np.floor(low[owner]).astype(np.int64)  # ranks are dealt with in blocks of length 1
        blocks = np.ceil(high[owner]).astype(np.int64) - first
        block = np.repeat(first, blocks) + _count_up(blocks)
        owner, key = np.repeat(owner, blocks), mixed(np.repeat(key, blocks), block)
        room = None if room is None else np.repeat(room, blocks)
        rank, found, step = block.astype(float), [], 0
        while len(key):
            step += 1
            dart = mixed(key, step)
            rank = rank - np.log(_uniform(dart))
            inside = (rank < block + 1) & (rank < high[owner])
            key, owner, block, rank, dart = key[inside], owner[inside], block[inside], rank[inside], dart[inside]
            room = None if room is None else room[inside]
            hit = rank >= low[owner]
            if room is not None:
                hit &= _uniform(mixed(dart, 3)) < room
            found.append((owner[hit] * k + (mixed(dart[hit], 1) % np.uint64(k)).astype(np.int64), rank[hit], mixed(dart[hit], 2)))
        slot, rank, value = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((value, rank, slot))
        slot, value = slot[order], value[order]
        earliest = np.concatenate([[True], slot[1:] != slot[:-1]]) if len(slot) else np.empty(0, bool)
        slot, value = slot[earliest], value[earliest]
        new = ~filled.reshape(-1)[slot]
        out.reshape(-1)[slot[new]] = value[new]
        filled.reshape(-1)[slot[new]] = True
        low, high = high, high * 2


def _count_up(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(signatures), bands))
    cut = signatures[:, :bands * rows].reshape(len(signatures), bands, rows)
    for i in range(rows):
        key = mixed(cut[:, :, i], key)
    return key


def band_rows(rows: DataFrame, bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """(band, node, size) of (doc, tkey, text); ``size`` is the weight of the text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 250) for i in range(0, batch.num_rows, 250)):
                regions, nodes = [], []
                for text in part.column(2):
                    tokens = words(text.as_py())
                    if tokens:
                        regions.append(cells(shingles(tokens)))
                        nodes.append(node_of(word_digest(tokens)))
                keys = band_keys(dart_minhash(regions, bands * per_band), bands, per_band)
                yield pa.RecordBatch.from_arrays(
                    [as_long(keys.reshape(-1)), pa.array(np.repeat(np.array(nodes, np.int64), bands)),
                     pa.array(np.repeat(np.array([len(r) for r in regions], np.int32), bands))], ["band", "node", "size"])

    return rows.mapInArrow(run, "band long, node long, size int")


# ------------------------------------------------------------------------------------------------------ comparisons

def set_rows(rows: DataFrame, wanted) -> DataFrame:
    """(node, elements) of the texts whose node a presence map lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 1 << 20):  # elements take more room than their text
                nodes, sets = [], []
                for text in part.column(2):
                    tokens = words(text.as_py())
                    node = node_of(word_digest(tokens))
                    if tokens and is_present(wanted.value, np.array([node], np.int64).view(np.uint64))[0]:
                        nodes.append(node)
                        sets.append(cells(shingles(tokens)).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), list_array(sets, pa.int64())], ["node", "elements"])

    return rows.mapInArrow(run, "node long, elements array<long>")


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similar) of pairs (a, b): exact weighted Jaccard similarity."""
    wanted = settle_small(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    own = sets.join(wanted, "node", "left_semi")
    left = own.select(F.col("node").alias("a"), F.col("elements").alias("of_a"))
    right = own.select(F.col("node").alias("b"), F.col("elements").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", (both / (F.size("of_a") + F.size("of_b") - both)).alias("similar")).distinct())


def _fit(a: str, b: str):
    """The similarity that two sizes allow."""
    return F.least(a, b) / F.greatest(a, b)


def _leaders(members: DataFrame, place) -> DataFrame:
    """(band, lead_node, lead_size, lead_root): the first member of each band by ``place``."""
    return members.groupBy("band").agg(F.min(F.struct(place.alias("place"), "node", "size", "root")).alias("lead")).select(
        "band", *[F.col(f"lead.{c}").alias(f"lead_{c}") for c in ("node", "size", "root")])


def _mixed(members: DataFrame) -> DataFrame:
    """(band, main): the bands whose members are of several classes, and the class that most of them are in."""
    held = members.groupBy("band", "root").agg(F.count("*").alias("n"))
    return held.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("classes")).where(
        "classes > 1").select("band", "main")


def _with_roots(members: DataFrame, linked: DataFrame) -> DataFrame:
    root = components(linked).withColumnRenamed("root", "new_root")
    return members.drop("root").join(root, "node", "left").withColumn("root", F.coalesce("new_root", "node")).drop("new_root")


def links(bands: DataFrame, sets: DataFrame, similar: float = SIMILAR, progress: float = PROGRESS) -> DataFrame:
    """(a, b) of linked texts: enough links to connect all texts that met in a bucket and are similar."""
    # who meets the most others is likely what they were copied from, and the leader that links most of them
    crowd = bands.groupBy("band").agg(F.count("*").alias("n"))
    met_by = bands.join(crowd, "band").groupBy(F.col("node").alias("of")).agg(F.sum("n").alias("others"))
    members = written(bands.join(met_by, F.col("node") == F.col("of")).select(
        "band", "node", "size", "others", F.col("node").alias("root")), "members")
    first = written(_leaders(members, -F.col("others")).select("band", "lead_node", "lead_size"), "first")
    asking, checked = members, None
    while True:
        leaders = written(_leaders(asking, -F.col("others") if checked is None else F.xxhash64("node")), "leaders")
        met = asking.join(leaders, "band").where((F.col("root") != F.col("lead_root")) & (_fit("size", "lead_size") >= similar))
        met = written(met.select("band", F.greatest("node", "lead_node").alias("a"), F.least("node", "lead_node").alias("b")), "met")
        ask = met.select("a", "b").distinct()
        if checked is not None:
            ask = ask.join(checked, ["a", "b"], "left_anti")
        fresh = written(compare(written(ask, "ask"), sets), "compared")
        found = fresh.where(F.col("similar") >= similar).select("a", "b")
        linked = found if checked is None else linked.unionByName(found)
        checked = fresh if checked is None else checked.unionByName(fresh)
        members = written(_with_roots(members, linked), "members")
        members = written(members.join(_mixed(members), "band"), "members")
        # a band with many left goes on with a leader from outside its main class, while leaders link their share
        moved = (met.join(found.withColumn("yes", F.lit(1)), ["a", "b"], "left").groupBy("band")
                 .agg(F.count("yes").alias("yes"), F.count("*").alias("asked"))
                 .where((F.col("asked") > FEW) & (F.col("yes") >= progress * F.col("asked"))))
        served = leaders.join(members.select("band", F.col("node").alias("lead_node"), F.col("root").alias("served")), ["band", "lead_node"])
        asking = (members.join(asking.select("band", "node"), ["band", "node"], "left_semi")
                  .join(moved.select("band"), "band", "left_semi").join(served.select("band", "served"), "band")
                  .where((F.col("root") != F.col("main")) & (F.col("root") != F.col("served"))).drop("main", "served"))
        members, asking = members.drop("main"), written(asking, "asking")
        if asking.isEmpty():
            break
    more = compare(written(apart(members, first, sets, similar).join(checked, ["a", "b"], "left_anti"), "cross"), sets)
    return written(linked.unionByName(more.where(F.col("similar") >= similar).select("a", "b")).distinct(), "links")


def apart(members: DataFrame, first: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(a, b), a > b, of members of one band and different classes that may be similar. No similar pair is left out.

    Let D be what a set and the set of the band's first leader L do not share, and k = (1 - t) / (1 + t), so that A and B
    are similar if |A xor B| <= k (|A| + |B|). As A xor B = D_A xor D_B, that is 2 |D_A and D_B| >= s_A + s_B with the
    slack s = |D| - k |set|. The one with the larger slack is not similar to L (else both were, and of one class), which
    bounds both slacks, so the overlap is at least

    * max(s, (k |L| + s) / 2) for the nearer one,
    * s - k |A| / t for the farther one,

    and at least 1. Two sets with an overlap of o share one of the first |D| - o + 1 elements of each, in any fixed order:
    the rarest come first, and those that one member alone has need not be sent. Copies with changes of their own share
    little but what the leader has, so few meet however many they are.
    """
    k = (1 - similar) / (1 + similar)
    rows = written(members.join(first, "band").where("node != lead_node").groupBy("lead_node", "node").agg(
        F.first("size").alias("size"), F.first("lead_size").alias("lead_size"), F.first("root").alias("root")), "apart")
    several = rows.groupBy("lead_node").agg(F.count("*").alias("n")).where("n > 1").select("lead_node")
    rows = rows.join(several, "lead_node", "left_semi")
    own = sets.select(F.col("node").alias("of"), "elements")
    lead = sets.select(F.col("node").alias("of_lead"), F.col("elements").alias("lead_elements"))
    differ = F.concat(F.array_except("elements", "lead_elements"), F.array_except("lead_elements", "elements"))
    diff = written(rows.join(own, F.col("node") == F.col("of")).join(lead, F.col("lead_node") == F.col("of_lead"))
                   .select("lead_node", "node", "size", "lead_size", "root", differ.alias("d")), "diff")
    each = diff.select("lead_node", "node", F.explode("d").alias("e"))
    shared = each.groupBy("lead_node", "e").agg(F.count("*").alias("n")).where("n > 1")
    held = each.join(shared, ["lead_node", "e"]).groupBy("lead_node", "node").agg(
        F.sort_array(F.collect_list(F.struct("n", "e"))).alias("common"))  # no more than the elements of two texts
    n, c = F.size("d"), F.size("common")
    slack = n - k * F.col("size")
    known = diff.join(held, ["lead_node", "node"]).select(
        "lead_node", "node", "root", "common", slack.alias("slack"), n.alias("n"), c.alias("c"),
        (n > k * (F.col("size") + F.col("lead_size")) - EPS).alias("outside"),
        F.greatest(slack, (k * F.col("lead_size") + slack) / 2).alias("near"), (slack - k / similar * F.col("size")).alias("far"))
    known = written(known, "known")

    def sent(rows: DataFrame, overlap: str, tag: str) -> DataFrame:
        least = F.greatest(F.ceil(F.col(overlap) - EPS), F.lit(1))
        first_ones = F.greatest(F.least(F.col("n") - least + 1 - (F.col("n") - F.col("c")), F.col("c")), F.lit(0)).cast("int")
        return rows.select("lead_node", F.explode(F.slice("common", F.lit(1), first_ones)).alias("_s"), *[
            F.col(x).alias(f"{x}_{tag}") for x in ("node", "root", "slack", "c")]).withColumn("e", F.col("_s.e")).drop("_s")

    pairs = sent(known.where("outside"), "far", "f").join(sent(known, "near", "n"), ["lead_node", "e"]).where(
        (F.col("root_f") != F.col("root_n")) & (F.struct("slack_n", "node_n") < F.struct("slack_f", "node_f"))
        & (F.col("slack_f") + F.col("slack_n") <= 2 * F.least("c_f", "c_n") + EPS))
    return pairs.select(F.greatest("node_f", "node_n").alias("a"), F.least("node_f", "node_n").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of (a, b) is connected with.

    Labels take the least label of the neighbours, then that label's own label, until nothing changes.
    """
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        told = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("told")))
        lower = written(labels.join(told, F.col("node") == F.col("a"))
                        .select("node", F.least("root", "told").alias("root"), F.col("root").alias("old")), "labels")
        of = lower.select(F.col("node").alias("via"), F.col("root").alias("jump"))
        new = written(lower.join(of, F.col("root") == F.col("via"))
                      .select("node", F.least("root", "jump").alias("root"), "old"), "labels")
        if new.where("root != old").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")


def near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc, tkey, node, n_words, root, class_doc) for every row of (doc_id, text); ``root`` tells classes apart,
    ``class_doc`` is the smallest id of a class (several classes share it where ids are null or have several texts)."""
    table, searched = searched_texts(keyed(docs))
    bands = written(band_rows(searched), "bands")
    crowded = bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    shared = bands.join(crowded.select("band"), "band", "left_semi")
    met = written(shared.distinct(), "shared")  # rows with one id and equal words, or without ids, are one node
    wanted = docs.sparkSession.sparkContext.broadcast(presence_map(met, "node"))
    sets = written(set_rows(searched, wanted), "sets")
    if not sets.groupBy("node").count().where("count > 1").isEmpty():
        sets = written(sets.dropDuplicates(["node"]), "sets")
    group = components(links(met, sets, similar))
    labelled = table.join(group, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = labelled.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("class_doc"))
    return labelled.join(heads, F.col("root") == F.col("of")).select(
        "doc", "tkey", "node", "n_words", "root", "class_doc")


@query("op6_dart_minhash")
def op6_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document; the document whose id names the class is kept."""
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text")).select(
        doc_value(F.col("doc")).alias("doc_id"), doc_value(F.col("class_doc")).alias("class_id"),
        (F.col("doc") == F.col("class_doc")).alias("kept"))

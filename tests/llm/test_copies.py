"""Near copies and repeated passages against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import ODD, SF
from pyspark.sql import functions as F

from stayline.llm import dart_minhash as dm
from stayline.llm import substring_dedup as sd
from stayline.llm import text_keys
from stayline.llm.common import words
from stayline.llm.text_keys import is_present, presence_map


# ---- brute force

def bag(text):
    w = words(text)
    n = min(dm.SHINGLE, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else float(a == b)


def brute_classes(rows):
    """Smallest id of the connected component of each row of (id, text)."""
    ids = [float("inf") if i is None else i for i, _ in rows]
    bags = [bag(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if similarity(bags[a], bags[b]) >= dm.SIMILAR:
                root[find(a)] = find(b)
    low = defaultdict(lambda: float("inf"))
    for i in range(len(rows)):
        low[find(i)] = min(low[find(i)], ids[i])
    return [low[find(i)] for i in range(len(rows))]


def brute_removed(rows, window=sd.WINDOW):
    """(id, words, removed, digest of the kept words) of each row of (id, text)."""
    first = {}
    keyed = [(float("inf") if i is None else i, words(t)) for i, t in rows]
    for i, w in keyed:
        for p in range(len(w) - window + 1):
            gram = tuple(w[p:p + window])
            first[gram] = min(first.get(gram, i), i)
    out = []
    for (i, _), (key, w) in zip(rows, keyed):
        gone = {p + j for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < key for j in range(window)}
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


# ---- DartMinHash

def test_agreement_estimates_weighted_similarity():
    random = np.random.RandomState(5)
    for share in (0.3, 0.8, 0.95):
        both = random.randint(0, 1 << 60, int(1000 * share)).astype(np.uint64)
        own = [random.randint(0, 1 << 60, (1000 - len(both)) // 2).astype(np.uint64) for _ in range(2)]
        sets = [np.sort(np.concatenate([both, x])) for x in own]
        a, b = dm.dart_minhash([dm.cells(s) for s in sets], 2048)
        true = len(both) / (len(both) + len(own[0]) + len(own[1]))
        assert (a == b).mean() == pytest.approx(true, abs=0.04)


def test_fractional_weights():
    cells = dm.cells(np.arange(1, 201, dtype=np.uint64))
    half = np.where(np.arange(200) < 100, 1.0, 0.5)
    a, b = dm.dart_minhash([cells, cells], 4096, [np.ones(200), half])
    assert (a == b).mean() == pytest.approx(150 / 200, abs=0.03)


def test_signature_does_not_depend_on_company():
    random = np.random.RandomState(6)
    sets = [dm.cells(np.sort(random.randint(0, 1 << 60, n).astype(np.uint64))) for n in (1, 3, 700, 20_000, 0)]
    together = dm.dart_minhash(sets, 64)
    for i, one in enumerate(sets):
        assert (dm.dart_minhash([one], 64)[0] == together[i]).all()
    assert (together[:4] != 0).all() and (together[4] == 0).all()


def test_classes_of_the_query(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in dm.op6_dart_minhash(spark, SF).collect()}
    want = dict(zip([i for i, _ in rows], brute_classes(rows)))
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.class_id) for i, r in got.items())


def chain(spark):
    """Texts of which neighbours are similar and the ends are not, a crowd of near copies, and lookalikes below 0.8."""
    base = [f"a{i}" for i in range(200)]
    rows = [(i, " ".join([f"z{j}" for j in range(i * 6)] + base[i * 6:])) for i in range(12)]
    crowd = [f"c{i}" for i in range(120)]
    rows += [(100 + i, " ".join(crowd[:i % 100] + [f"x{i}"] + crowd[i % 100 + 1:])) for i in range(60)]
    rows += [(300 + i, " ".join(crowd[:70] + [f"y{i}_{j}" for j in range(50)])) for i in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string"), rows


def test_chains_crowds_and_lookalikes(spark):
    frame, rows = chain(spark)
    got = {r.doc: r.class_doc for r in dm.near_duplicates(frame.repartition(5)).collect()}
    assert got == dict(zip([i for i, _ in rows], brute_classes(rows)))


def test_near_copies_odd_rows(odd, none):
    got = dm.near_duplicates(odd).collect()
    want = Counter(zip([1 << 63 if i is None else i for i, _, _ in ODD], brute_classes([(i, t) for i, t, _ in ODD])))
    assert Counter((1 << 63 if r.doc == (1 << 63) - 1 else r.doc, float("inf") if r.class_doc == (1 << 63) - 1 else r.class_doc)
                   for r in got) == want
    assert dm.near_duplicates(none).count() == 0


def test_copies_are_searched_once_at_every_size(spark, odd, monkeypatch):
    monkeypatch.setattr(text_keys, "COPIES", 0)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, " ".join(base)) for i in range(20)] + [(20 + i, " ".join(base[:-1] + ["other"])) for i in range(20)]
    rows += [(None, " ".join(base[:-2] + ["none"]))] * 15 + [(50, " ".join(base[1:]) + " " * i) for i in range(15)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    _, searched = text_keys.searched_texts(text_keys.keyed(frame))
    assert searched.count() == 2 + 30  # copies of a smaller id are left out
    seen, links = [], dm.links
    monkeypatch.setattr(dm, "links", lambda bands, sets, similar: seen.append((bands, sets)) or links(bands, sets, similar))
    got = dm.near_duplicates(frame).collect()
    assert {r.class_doc for r in got} == {0} and len(got) == len(rows)
    bands, sets = seen[0]
    assert sets.count() == sets.select("node").distinct().count() == 4
    assert bands.count() == bands.select("band", "node").distinct().count()
    want = Counter(brute_classes([(i, t) for i, t, _ in ODD]))
    none = (1 << 63) - 1
    assert Counter(float("inf") if r.class_doc == none else r.class_doc for r in dm.near_duplicates(odd).collect()) == want
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd_rows(*sd.remove_repeats(odd))) == Counter(
        brute_removed([(i, t) for i, t, _ in ODD]))


def test_presence_map_never_denies(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"))
    found = presence_map(rows, "h", 16)
    held = np.array([r.h for r in rows.collect()], np.int64).view(np.uint64)
    assert is_present(found, held).all() and not is_present(found, np.random.RandomState(1).randint(
        0, 1 << 62, 5000).astype(np.uint64)).all()


# ---- substring dedup

def test_every_window_has_an_anchor_of_its_own_words():
    random = np.random.RandomState(2)
    text = random.randint(0, 1 << 60, 400).astype(np.uint64)
    found = sd.anchors(text)
    for at in (0, 17, 300):
        alone = sd.anchors(text[at:at + sd.WINDOW])
        assert len(alone) == 1 and alone[0] == found[at]


def test_repeats_odd_rows(odd, none):
    table, cut = sd.remove_repeats(odd)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd_rows(table, cut))
    assert got == Counter(brute_removed([(i, t) for i, t, _ in ODD]))
    table, cut = sd.remove_repeats(none)
    assert table.count() == 0 and cut.count() == 0


def sd_rows(table, cut):
    return sd.report(table, cut).collect()


def test_repeats_across_edges(spark):
    passage = [f"p{i}" for i in range(40)]
    rows = [(5, " ".join(["q"] * 20 + passage)), (3, " ".join(passage[5:30])), (9, " ".join(passage[:13] + ["m"] + passage[13:])),
            (4, " ".join(passage[:12])), (8, " ".join(passage[20:] + passage[:20])), (1, "q " * 30), (2, "r " * 12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in sd_rows(*sd.remove_repeats(frame)))
    assert got == sorted(brute_removed(rows))


def brute_spans(rows, window=13):
    """Windows beside the first place in the smallest document, joined while both sides go on."""
    texts = {i: words(t) for i, t in rows}
    places = {}
    for i in sorted(texts):
        for at in range(len(texts[i]) - window + 1):
            places.setdefault(tuple(texts[i][at:at + window]), (i, at))
    out = []
    for i, tokens in texts.items():
        run = None
        for at in range(len(tokens) - window + 1):
            source, place = places[tuple(tokens[at:at + window])]
            if source == i:
                run = None
            elif run and run[3] == source and run[4] - run[1] == place - at:
                run[2] = at + window
            else:
                run = [i, at, at + window, source, place]
                out.append(run)
    return sorted(map(tuple, out))


@pytest.mark.parametrize("batch", [10_000, 7])
def test_spans_are_maximal_matches(spark, batch):
    random = np.random.RandomState(5)
    passages = [[f"s{k}w{i}" for i in range(random.randint(13, 120))] for k in range(6)]
    rows = []
    for i in range(1, 61):
        text = [f"d{i}w{j}" for j in range(random.randint(0, 30))]
        for _ in range(random.randint(1, 4)):
            passage = passages[random.randint(0, 6)]
            lo = random.randint(0, len(passage) // 2)
            text += passage[lo:lo + random.randint(5, 100)] + [f"d{i}x{random.randint(0, 99)}"] * random.randint(0, 20)
        rows.append((i, " ".join(text)))
    rows += [(70, "again " * 60), (71, "so again " + "again " * 90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = [(r.doc, r.start, r.end, r.source, r.source_start) for r in sd.repeat_spans(frame)[2].collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(got) == brute_spans(rows) and len(got) > 40
    texts = {i: words(t) for i, t in rows}
    for doc, start, end, source, at in got:
        assert end - start >= 13 and texts[doc][start:end] == texts[source][at:at + end - start]


# ---- a large group of near copies

def near_group(number, edits, words_=150, seed=3, bases=1):
    """Copies of some base texts with words of their own here and there; edits as many as the random draw says."""
    random, rows = np.random.RandomState(seed), []
    texts = [[f"b{k}w{i}" for i in range(words_)] for k in range(bases)]
    for k in range(1, bases):  # the bases share half of their words with the first
        texts[k][:words_ // 2] = texts[0][:words_ // 2]
    for i in range(number):
        text = list(texts[i % bases])
        for place in random.randint(0, words_, random.choice(edits)):
            text[place] = f"own{random.randint(0, 4) if random.rand() < 0.1 else random.randint(0, 1 << 40)}"
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("edits, bases", [([0, 1, 2, 3, 4, 6, 9, 14], 1), ([4, 5, 6], 1), ([0, 1, 2, 3, 5], 3)])
def test_large_near_group_keeps_all_links(spark, edits, bases):
    rows = near_group(260, edits, bases=bases)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc: r.class_doc for r in dm.near_duplicates(df).collect()}
    assert [got[i] for i, _ in rows] == brute_classes(rows)


def test_apart_leaves_out_no_similar_pair(spark):
    """All members in one band, every pair of different classes that is similar is among the candidates."""
    rows = near_group(150, [1, 2, 3, 4, 5])
    bags = {i: dm.cells(dm.shingles(words(t))).view(np.int64) for i, t in rows}
    sets = spark.createDataFrame([(i, e.tolist()) for i, e in bags.items()], "node long, elements array<long>")
    lead = 1
    near = {(a, b): len(set(bags[a]) & set(bags[b])) / len(set(bags[a]) | set(bags[b])) for a in bags for b in bags if b < a}
    alike = {i for i in bags if i == lead or near[max(i, lead), min(i, lead)] >= 0.8}
    members = spark.createDataFrame([(7, i, len(e), 1, lead if i in alike else i) for i, e in bags.items()],
                                    "band long, node long, size int, others long, root long")
    first = spark.createDataFrame([(7, lead, len(bags[lead]))], "band long, lead_node long, lead_size int")
    got = {tuple(r) for r in dm.apart(members, first, sets).collect()}
    want = {p for p, s in near.items() if s >= 0.8 and not (p[0] in alike and p[1] in alike) and lead not in p}
    assert want and want <= got
    assert len(got) < len(near) / 2


def test_candidates_grow_with_the_group_not_its_square(spark):
    """Copies with words of their own, about as far from each other as from being similar: hardly any of them meet."""
    counts = []
    for n in (400, 1600):
        rows = near_group(n, [4, 5, 6, 7, 8])
        keyed = text_keys.keyed(spark.createDataFrame(rows, "doc_id long, text string"))
        bands = text_keys.written(dm.band_rows(keyed), "bands").distinct()
        wanted = spark.sparkContext.broadcast(presence_map(bands, "node"))
        sets = text_keys.written(dm.set_rows(keyed, wanted), "sets")
        one = bands.groupBy("node").agg(F.first("size").alias("size")).select(
            F.lit(1).alias("band"), "node", "size", F.lit(1).alias("others"), F.col("node").alias("root"))
        first = one.orderBy("node").limit(1).select("band", F.col("node").alias("lead_node"), F.col("size").alias("lead_size"))
        counts.append(dm.apart(text_keys.written(one, "one"), text_keys.written(first, "first"), sets).count())
    assert counts[1] < 1600 * 8 and counts[1] < 10 * max(counts[0], 100)

"""Periodic runs, WARC archives and token alignment against brute force and round trips."""

import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import LONG, ODD, SF
from pyspark.sql import functions as F

from stayline.llm import periodic_runs, token_alignment, warc
from stayline.llm.common import words
from stayline.llm.token_files import vocabulary_path
from stayline.plans.durable import work_path

BYTES, PIECES = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- periodic runs

def brute_runs(tokens, shortest=24, repeats=3):
    n, out = len(tokens), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and tokens[j] == tokens[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, repeats * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def some_texts(rng, number):
    for _ in range(number):
        text = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice([1, 2, 3, 5, 8, 9, 15, 16, 17, 31, 32, 40, 70])
            unit = [str(rng.randint(0, rng.choice([1, 3, 1000]))) for _ in range(p)]
            text += [unit[i % p] for i in range(int(p * rng.uniform(1, 6)))]
            text += [str(rng.randint(0, 3)) for _ in range(rng.randint(0, 12))]
        yield text


@pytest.mark.parametrize("shortest, repeats", [(24, 3), (40, 4)])
def test_runs_are_those_of_brute_force(shortest, repeats):
    texts = [*some_texts(random.Random(shortest), 150), [], ["a"] * 24, ["a"] * 23, ["a", "b"] * 400]
    got = periodic_runs.Words(texts).runs(shortest, repeats)
    assert sum(map(len, got)) > 50
    assert got == [brute_runs(t, shortest, repeats) for t in texts]


def test_runs_with_periods_beyond_a_block():
    period = 2 * periodic_runs.BLOCK + 77
    text = ["x", "y"] + [str(i % period) for i in range(3 * period + 5)] + ["z"]
    assert periodic_runs.Words([["q"] * 3, text, ["q"] * 30]).runs() == [[], [(2, 3 * period + 5, period)], [(0, 30, 1)]]


@pytest.mark.parametrize("size", [16, 32, 64, 128, 1024, 2048])
def test_transforms_are_exact(size):
    rng = np.random.default_rng(size)
    top = periodic_runs.PRIME
    blocks, windows = rng.integers(top - 9, top, (3, size // 2)), rng.integers(0, top, (3, size))
    got = periodic_runs.correlate(blocks.astype(float), windows.astype(float)) % top
    want = [[sum(int(a) * int(b) for a, b in zip(p, w[d:d + size // 2])) % top for d in range(size // 2 + 1)]
            for p, w in zip(blocks, windows)]
    assert got.astype(np.int64).tolist() == want


def test_false_zeros_are_sorted_out(monkeypatch):
    """Numbers that agree modulo the prime only."""
    texts = [["a", "b"] * 20 + ["c"] * 5 + ["a"] * 30]
    found = periodic_runs.Words(texts)
    monkeypatch.setattr(found, "numbers", found.numbers * 0)
    monkeypatch.setattr(found, "squares", found.squares * 0)
    assert found.runs() == [brute_runs(texts[0])]


def test_runs_of_odd_rows(odd, none):
    got = periodic_runs.periodic_runs(odd).collect()
    assert len(got) == len(ODD)
    texts = Counter((i, tuple(brute_runs(words(t))[:50]), " ".join(words(t))) for i, t, _ in ODD if t is None or len(t) < 1000)
    assert texts == Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in got if r.n_words < 1000)
    assert all(len(r.runs) == 1 and r.runs[0].period == 4001 for r in got if r.n_words >= 30_000)
    assert {r.n_words - len(r.collapsed.split(" ")) for r in got if r.n_words >= 30_000} == {30_000 - 4001}
    assert periodic_runs.periodic_runs(none).count() == 0


def test_runs_query_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = [(10_000 + i, " ".join(t)) for i, t in enumerate(some_texts(random.Random(5), 60))]
    all_ = docs.unionByName(spark.createDataFrame([*extra, (None, "a " * 30), (9_000_001, None), (9_000_002, "")], docs.schema))
    all_.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in periodic_runs.op11_periodic_runs(spark, str(tmp_path)).collect()}
    rows = all_.where("length(text) < 3000 or text is null").collect()
    assert len(rows) > 150
    for row in rows:
        t = words(row.text)
        h = zlib.crc32(str(row.doc_id).encode()) if row.doc_id is not None else 1
        if h % 10 == 0 and t:
            n, g = len(t), h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            t = [t[i] if i < a else t[a + (i - a) % p] for i in range(n)]
        runs, r = brute_runs(t), got[row.doc_id]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, (r.start, r.length, r.period)) == (len(runs), best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join("%d,%d,%d\n" % x for x in runs))
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(t) if i not in gone))
    assert sum(r.n_runs > 0 for r in got.values()) > 30


def test_strongest_run_is_exact(spark):
    rows = spark.createDataFrame([([(5, 30, 10), (2, 27, 9), (2, 30, 10), (0, 29, 10)],), ([],), ([(0, 3000000001, 1000000000), (1, 3, 1)],)],
                                 f"runs {periodic_runs.RUNS}")
    got = [tuple(r[0]) if r[0] else None for r in rows.select(periodic_runs.strongest(F.col("runs"))).collect()]
    assert got == [(2, 27, 9), None, (0, 3000000001, 1000000000)]


def test_fewer_than_three_periods_are_refused(docs):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, repeats=2)


# ---- archives

PAGES = "page_id long, url string, html string, row long, digest string"
BIG, OTHER = "<p>" + "ä€🙂" * 40 + "</p>", "<b>" + "x" * 300 + "</b>"
ROWS = [(5, "u5", BIG), (3, "u3", BIG), (9, None, BIG), (3, "a3", BIG), (None, "n", BIG), (1, "http://a/ b\nc", "tiny"),
        (2, "u2", "tiny"), (4, "u4", None), (6, "u6", ""), (7, "u7", OTHER), (7, "u7", OTHER), (None, "m", "y" * 200),
        (None, "m", "y" * 200), (8, "u8", "w" * 2_000_000)]


@pytest.fixture(scope="module")
def archives(spark):
    pages = spark.createDataFrame([(*r, 1, "x") for r in ROWS], PAGES).repartition(3)
    folder = work_path(spark, "warc-test")
    return folder, warc.write_archives(pages, folder).cache()


def test_every_page_has_a_record(archives):
    folder, index = archives
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in warc.resolve_revisits(warc.read_records(index, folder)).collect())
    want, first = Counter(), {}
    for page, url, html in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        raw = (html or "").encode()
        again = len(raw) >= 100 and raw in first
        want[page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None] += 1
        first.setdefault(raw, page)
    assert got == want


def test_originals_through_the_shuffle_are_the_same(spark, monkeypatch):
    pages = spark.createDataFrame([(*r, 1, "x") for r in ROWS], PAGES).repartition(3)
    monkeypatch.setattr(warc, "BROADCAST", 0)
    folder = work_path(spark, "warc-test")
    rows = warc.resolve_revisits(warc.read_records(warc.write_archives(pages, folder), folder)).collect()
    assert len(rows) == len(ROWS) and sum(r.record_type == "revisit" for r in rows) == 6
    assert {r.refers_to for r in rows if r.record_type == "revisit"} == {3, 7, None}


def test_archives_are_plain_gzip_members(archives):
    """Another reader, without the index, meets the same records."""
    import glob
    folder, index = archives
    found = 0
    for name in glob.glob(f"{folder.removeprefix('file:')}/*.warc.gz"):
        with gzip.open(name) as f:
            data = f.read()
        while data:
            fields, block = warc.parse_record(data)
            data = data[data.index(warc.END) + 4 + len(block) + 4:]
            found += fields["warc-type"] in ("response", "revisit")
            assert " " not in fields.get("warc-target-uri", "") and "\n" not in fields.get("warc-target-uri", "")
            if fields["warc-type"] == "revisit":
                assert block.partition(warc.END)[2] == b"" and fields["warc-refers-to"].startswith("<urn:uuid:")
    assert found == len(ROWS) == index.count()
    assert {r.url for r in index.collect()} == {u for _, u, _ in ROWS}


def test_some_records_by_their_index_rows(archives):
    folder, index = archives
    got = warc.read_records(index.where("page_id = 1 or page_id = 8"), folder).collect()
    assert {(r.page_id, bytes(r.payload)) for r in got} == {(1, b"tiny"), (8, b"w" * 2_000_000)}


def test_a_wrong_offset_is_noticed(archives):
    folder, index = archives
    with pytest.raises(Exception):
        warc.read_records(index.where("page_id = 1").withColumn("offset", F.col("offset") + 1), folder).collect()
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort")


def test_neighbouring_ranges_are_one_read():
    ranges = [warc.joined_ranges(np.array(o), np.array(n), gap=10, most=100) for o, n in (
        ([0, 20, 45, 90], [20, 20, 30, 20]), ([0, 300], [200, 5]), ([0], [7]), ([], []))]
    assert ranges == [[(0, 3), (3, 4)], [(0, 1), (1, 2)], [(0, 1)], []]


def test_archives_of_no_pages(spark):
    folder = work_path(spark, "warc-test")
    index = warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.resolve_revisits(warc.read_records(index, folder)).count() == 0


# ---- token alignment

@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(BYTES, PIECES)


def brute_alignment(aligner, text):
    if not text:
        return 0, 0, 0, "", []
    ids_a = aligner.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    ids_b = aligner.b.processor.encode(text)
    a, b = [aligner.a.spelled[i] for i in ids_a], [aligner.b.spelled[i] for i in ids_b]
    if not b"".join(a) == b"".join(b) == (" " + text).encode():
        return 0, 0, 0, "", []
    ends_a, ends_b = np.cumsum([len(x) for x in a]).tolist(), np.cumsum([len(x) for x in b]).tolist()
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
        links.append((ids_a[k - 1], ids_b[m - 1]))
        i, j = k, m
    return len(ids_a), len(ids_b), len(groups), ";".join(groups), links


PARTS = ["a", "b", " ", "  ", "\n", "\t", "\xa0", "　", "'s", "é", "日", "🙂", "▁", "<|endoftext|>", "</s>", "<s>", "<0x41>", "1",
         "23", ".", "!!", "ing", "the", "\x1c", "̀", "\r", "\x85", " ", "İ", "हिन्दी", "\0", "﻿", "\U000e0001", "lower"]


def test_alignment_is_that_of_brute_force(aligner):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += [None, "", " ", "  ", "\n", *[t for _, t, _ in ODD if t is None or len(t) < 1000]]
    size = len(aligner.b.spelled)
    for _ in range(2):  # the second time from memory
        counts, groups, links = aligner.align(texts)
        for i, text in enumerate(texts):
            pairs = [divmod(k, size) for k in links[i].tolist()]
            assert (*counts[i].tolist(), groups[i], pairs) == brute_alignment(aligner, text), text
    assert (counts[:, 0] > 0).sum() > 1500


def test_alignment_without_chunks_and_with_little_memory(aligner):
    small = token_alignment.Aligner(BYTES, PIECES, chunks=3)
    whole = token_alignment.Aligner(BYTES, PIECES)
    whole.cuts = False
    texts = ["some words of a text", "some more  words\n", None, "the ▁ sign", "naïve 🙂"]
    want = aligner.align(texts)
    for other in (small, whole):
        for _ in range(2):
            got = other.align(texts)
            assert got[1] == want[1] and got[0].tolist() == want[0].tolist()
            assert [x.tolist() for x in got[2]] == [x.tolist() for x in want[2]]


def test_pointers_reach_the_end_of_long_chains():
    n = 5000
    a, b = np.arange(1, n + 1) * 2, np.concatenate([[1], np.arange(1, n) * 2 + 1, [2 * n]])
    of_a, of_b = token_alignment.group_ends(a, b)  # tokens that overlap like bricks
    assert set(of_a) == set(of_b) == {n - 1}
    of_a, of_b = token_alignment.group_ends(np.array([2, 3, 6]), np.array([1, 3, 4, 5, 6]))
    assert of_a.tolist() == [1, 1, 2] and of_b.tolist() == [1, 1, 2, 2, 2]


def test_byte_letters_are_the_vocabulary(aligner):
    assert len(token_alignment.byte_letters()) == 256
    assert b"".join(aligner.a.spelled[i] for i in aligner.a.encode([" hé\n🙂"])[0]) == " hé\n🙂".encode()


def test_alignment_query_against_brute_force(spark, odd, tmp_path, aligner):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80).select("doc_id", "text")
    long = F.when(F.length("text") < 1000, F.col("text")).otherwise(F.substring("text", 1, 5000))
    odd.select((F.col("doc_id") + 1_000_000).alias("doc_id"), long.alias("text")).unionByName(docs).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    known = [(r.doc_id, *brute_alignment(aligner, r.text)) for r in rows]
    count = Counter(pair for k in known for pair in k[5])
    best: dict = {}
    for (a, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    want = Counter((i, n_a, n_b, n_g, len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                    sha(groups) if n_a else "") for i, n_a, n_b, n_g, groups, links in known)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = Counter(tuple(r) for r in token_alignment.op13_token_alignment(spark, str(tmp_path)).select(*columns).collect())
    assert got == want


def test_alignment_of_no_rows(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert token_alignment.op13_token_alignment(spark, str(tmp_path)).count() == 0


def test_long_text_is_aligned_whole(aligner):
    counts, groups, links = aligner.align([LONG])
    assert tuple(counts[0].tolist()) == brute_alignment(aligner, LONG)[:3] and groups[0].count(";") + 1 == counts[0][2] == len(links[0])


def test_chunks_are_learnt_in_parts(aligner, monkeypatch):
    small, asked = token_alignment.Aligner(BYTES, PIECES), []
    encode = small.a.encode
    monkeypatch.setattr(small.a, "encode", lambda texts: asked.append(sum(t.count(" ") for t in texts)) or encode(texts))
    monkeypatch.setattr(token_alignment, "LEARNT", 7, raising=False)
    text = [" ".join(f"word{i}" for i in range(50)) + "  two \n"]
    counts, groups, links = small.align(text)
    assert max(asked) <= 7
    monkeypatch.undo()
    small.forget()
    again = small.align(text)
    assert counts.tolist() == again[0].tolist() and groups == again[1] and links[0].tolist() == again[2][0].tolist()

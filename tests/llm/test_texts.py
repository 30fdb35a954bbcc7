"""Operators that work on each text or on lines: line dedup, mixing, tokens, pieces, fingerprints, quality."""

import gc
import hashlib
import math
import re
import tracemalloc
import weakref
import zlib
from collections import Counter, defaultdict
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from conftest import LONG, ODD, SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayline.llm import common, fingerprints, line_dedup, mixing, quality, sentencepiece_fst, token_files
from stayline.llm.common import Memo, kept_alone, words
from stayline.llm.token_files import vocabulary_path
from stayline.plans.durable import work_path

PIECES = vocabulary_path("piece_bpe_32k.model")
TOKENS = vocabulary_path("word_bpe_49k.json")
TEXTS = [t or "" for _, t, _ in ODD]


def test_words_split_at_ascii_space_only():
    assert words("a b c\n\nd ") == ["a b", "c", "d"]
    assert words("") == words(None) == []


def test_memo_is_bounded():
    memo = Memo(lambda x: x + 1, 10)
    assert [memo[i] for i in range(25)] == list(range(1, 26)) and len(memo) <= 10


# ---- line dedup

def test_lines_of_a_host_go(odd):
    got = {(r.row.doc_id, r.row.row): r for r in line_dedup.drop_boilerplate(odd).collect()}
    assert got[12, "x"].kept == "first page of d" and got[14, "x"].kept == "third page of d\n\nend"
    assert (got[14, "x"].n_lines, got[14, "x"].n_removed) == (3, 1)
    assert got[2, "x"].kept is None and got[2, "x"].n_lines == 0
    assert got[8, "x"].n_removed == 0  # a host with fewer than MIN_PAGES pages
    assert got[6, "x"].n_removed == 1  # three rows of b hold this line
    assert got[3, "x"].kept == " \n\t " and got[3, "x"].n_removed == 0


def test_lines_of_no_rows(none):
    assert line_dedup.drop_boilerplate(none).count() == 0


def test_line_counts_once_per_page(spark):
    rows = spark.createDataFrame([(i, "dup\ndup\ndup" if i == 0 else f"own {i}", "h") for i in range(5)],
                                 "doc_id long, text string, source string")
    assert line_dedup.boilerplate_lines(rows, ratio=0.1, min_pages=2).count() == 0


# ---- mixing

def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + [n for n in sizes if n is None]
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [n for n in names if n not in full]
        left = budget - sum(2.0 * sizes[n] for n in full)
        total = sum(weight[n] for n in open_)
        target = {n: left * weight[n] / total if n not in full else 2.0 * sizes[n] for n in names}
        over = {n for n in open_ if target[n] > 2.0 * sizes[n]}
        if not over:
            return target
        full |= over


def test_mix_against_brute_force(docs, labels):
    rows = mixing.mix_sources(docs, labels).collect()
    size, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(words_of(docs)[r.doc_id]) and r.copies in (0, 1, 2)
        size[r.source] += r["size"]
        taken[r.source] += r["size"] * r.copies
    target = brute_targets(size)
    groups = defaultdict(list)
    for r in rows:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == size[r.source]
        groups[r.source].append(r)
    for source, members in groups.items():
        epochs = int(target[source] // size[source])
        rest, so_far, want = target[source] - epochs * size[source], 0, 0
        for r in sorted(members, key=lambda r: (r.key, r.doc_id)):
            chosen = so_far < rest and r["size"] <= 2 * (rest - so_far)
            assert r.copies == epochs + chosen
            so_far += r["size"]
            want += chosen * r["size"]
        assert taken[source] == epochs * size[source] + want


_WORDS = {}


def words_of(docs):
    if not _WORDS:
        _WORDS.update({r.doc_id: words(r.text) for r in docs.select("doc_id", "text").collect()})
    return _WORDS


def test_heavier_documents_come_first(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("size"),
                                      (F.col("id") % 2 * 3 + 1).cast("double").alias("w"), F.lit(0).cast("long").alias("tie"))
    rows = rows.withColumn("key", mixing.sampling_key(F.col("doc_id"), F.col("w")))
    plan, bounds = mixing.plan_mix(rows.drop("w"), share=0.25)
    got = mixing.with_copies(rows, plan, bounds)
    assert got.agg(F.sum("copies")).first()[0] == 5000
    by = {r.w: r.c for r in got.groupBy("w").agg(F.sum("copies").alias("c")).collect()}
    # of keys with rates 1 and 4, those below t: 1 - exp(-t) and 1 - exp(-4t) of 10,000 each
    t = next(x / 1e4 for x in range(1, 100_000) if 2 - math.exp(-x / 1e4) - math.exp(-4 * x / 1e4) >= 0.5)
    assert by[4.0] == pytest.approx(10_000 * (1 - math.exp(-4 * t)), rel=0.05)


def test_mix_odd_rows(odd, none, labels, spark):
    rows = mixing.mix_sources(odd, labels).collect()
    assert len(rows) == len(ODD) and sum(r["size"] for r in rows) == sum(len(words(t)) for _, t, _ in ODD)
    assert mixing.mix_sources(none, labels).count() == 0
    assert mixing.mix_sources(odd.limit(0).unionByName(odd), labels.limit(0)).count() == len(ODD)


# ---- token files

def test_perfect_hash():
    keys = np.unique(np.random.RandomState(1).randint(-1 << 62, 1 << 62, 20_000))
    table = token_files.PerfectHash.build(keys)
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    assert table.slots(np.array([keys[0] + 1])).shape == (1,)


def expected_tokens(rows):
    tokenizer, start, out = Tokenizer.from_file(TOKENS), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_tokens_read_back(spark, odd, none):
    folder = work_path(spark, "tokens")
    manifest = token_files.write_token_files(odd, folder, TOKENS, partitions=4)
    got = token_files.read_tokens(odd, folder, manifest).collect()
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(a), *b) for a, *b in expected_tokens([(i, t) for i, t, _ in ODD]))
    strange = spark.createDataFrame([(10 ** 9 + i,) for i in range(500)], "doc_id long")
    assert token_files.read_tokens(strange, folder, manifest).count() == 0
    empty = work_path(spark, "tokens")
    assert token_files.read_tokens(none, empty, token_files.write_token_files(none, empty, TOKENS)).count() == 0


def test_tokens_of_the_query(spark, docs):
    got = token_files.op7_token_files(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == expected_tokens(
        [(r.doc_id, r.text) for r in docs.collect()])


# ---- sentencepiece

def test_pieces_are_the_librarys(docs):
    machine, library = sentencepiece_fst.PieceTransducer(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*TEXTS, *[r.text for r in docs.select("text").collect()], "  lead", "trail ", "aaaaaaa", "́e", "x▁y", "( )  =>"]
    for text in texts:
        ids = machine.encode(text)
        assert ids == library.encode(text)
        assert machine.decode(ids) == library.decode(ids)


def test_shortest_path_is_least_cost():
    """Against all ways to spell short texts with a unigram reading of the same pieces."""
    machine = sentencepiece_fst.PieceTransducer(PIECES)
    machine.merges = False

    def best(text):
        if not text:
            return 0.0
        ways = [machine.spelled[text[:n]] for n in range(1, len(text) + 1) if text[:n] in machine.spelled]
        return min(-machine.scores[w] + best(text[len(machine_piece(w)):]) for w in ways)

    def machine_piece(i):
        return next(p for p, j in machine.spelled.items() if j == i)

    for text in ("the", "there", "nation", "▁in"):
        assert sum(-machine.scores[i] for i in machine.shortest_path(text)) == pytest.approx(best(text))


def test_pieces_odd_rows(odd, none):
    rows = sentencepiece_fst.encode_pieces(odd, PIECES).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and by_id[2].ids is None and by_id[1].ids == []
    for i, text, _ in ODD:
        if text is not None:
            assert by_id[i].ids == library.encode(text) and by_id[i].round_trip == ("▁" not in text)
    back = sentencepiece_fst.decode_pieces(sentencepiece_fst.encode_pieces(odd, PIECES), PIECES).collect()
    assert {r.doc_id: r.text for r in back}[9] == dict((i, t) for i, t, _ in ODD)[9]
    assert sentencepiece_fst.encode_pieces(none, PIECES).count() == 0


# ---- fingerprints

def phrases(text):
    seen, run = set(), ""
    for c in text:
        run += c
        if run not in seen:
            seen.add(run)
            run = ""
    return seen or ({run} if run else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_parse_and_its_way_back():
    for text in [*TEXTS[:9], "abababababab", "aaaaaaaaaa"]:
        parse = fingerprints.Parse()
        parse.feed(text)
        ends = parse.ends
        assert {text[a:b] for a, b in zip([0, *ends], ends)} | (phrases(text) if not ends else set()) == phrases(text)
        other = "zebra " + text[::-1]
        own, changed, edited = fingerprints.with_edit(text, other)
        half = len(text) // 2
        assert edited == text[:len(text) - half] + other[:half]
        assert own.tolist() == fingerprints.fingerprint(text).tolist()
        assert changed.tolist() == fingerprints.fingerprint(edited).tolist()


def test_fingerprints_against_whole_sets(docs, spark):
    rows = {r.doc_id: r for r in fingerprints.op3_fingerprints(spark, SF).collect()}
    texts = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    gap = []
    for k, (i, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        gap += [abs(rows[i].near_edited - jaccard(phrases(text), phrases(edited))),
                abs(rows[i].near_next - jaccard(phrases(text), phrases(after)))]
    assert np.mean(gap) < 0.05 and max(gap) < 0.2


def test_fingerprints_odd_rows(odd, none, spark):
    rows = fingerprints.fingerprint_documents(odd).collect()
    assert len(rows) == len(ODD)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[2].fingerprint == ""
    assert by_id[6].fingerprint == by_id[7].fingerprint and by_id[2].near_next == 1.0  # next to the empty one
    assert fingerprints.fingerprint_documents(none).count() == 0
    one = fingerprints.fingerprint_documents(odd.where("doc_id = 4")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


# ---- quality

def test_probabilities_add_up_and_thresholds_are_ordered():
    random = np.random.RandomState(3)
    rows, grades = [], []
    for i in range(900):
        g = i % 3
        rows.append(np.unique(np.concatenate([random.randint(0, 500, 30), [1000 + g] * (random.rand() < 0.9)]).astype(np.int32)))
        grades.append(g)
    chosen, weights, limits = quality.fit(rows, np.array(grades))
    assert limits[0] < limits[1] and {1000, 1002} <= set(chosen.tolist())
    weight = dict(zip(chosen.tolist(), weights))
    assert weight[1002] > 0 > weight[1000]


def test_fit_takes_little_more_memory_than_its_rows():
    random = np.random.RandomState(5)
    grades = np.arange(2000) % 3
    rows = [np.unique(random.randint(0, 1 << quality.BITS, 2000)).astype(np.int32) for _ in grades]
    rows = [np.union1d(r, [7]).astype(np.int32) if g == 2 else r for r, g in zip(rows, grades)]
    given = sum(r.nbytes for r in rows)
    tracemalloc.start()
    chosen, weights, _ = quality.fit(rows, grades)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 7 in chosen and weights[chosen == 7][0] > 0
    assert peak < 2 * given + (24 << quality.BITS) * 8  # what is held for each bucket, and no array of all features


def test_worker_keeps_one_helper_at_a_time():
    made = []
    big, small = (lambda n: made.append(n) or set(range(n))), (lambda n: made.append(-n) or [n])
    first = kept_alone(big, 5)
    assert kept_alone(big, 5) is first and made == [5]
    gone = weakref.ref(first)
    del first
    assert kept_alone(small, 1) == [1] and gone() is None
    assert kept_alone(big, 5) == set(range(5)) and made == [5, -1, 5]
    machine = sentencepiece_fst.transducer(PIECES, 10)
    assert sentencepiece_fst.transducer(PIECES, 10) is machine and machine.solved.limit == 5
    machine.encode("one two one two")
    held = [piece for pair in machine.pairs for piece in pair]
    assert len({id(piece) for piece in held}) == len(set(held))
    gone = weakref.ref(machine)
    del machine
    gc.disable()  # its memos refer to it
    try:
        kept_alone(small, 1)
        assert gone() is None
    finally:
        gc.enable()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, test = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    model = quality.fit_model(docs, train)
    assert (np.diff(model.limits) >= 0).all()
    graded = quality.grade_documents(docs.join(test.select("doc_id"), "doc_id", "left_semi"), model)
    got = graded.join(quality.graded(test), F.col("row.doc_id") == F.col("of_doc")).select("grade", "keep", "p_fair", "p_good").collect()
    kept = defaultdict(list)
    for r in got:
        kept[r.grade].append(r.keep)
        assert 0 <= r.p_good <= r.p_fair <= 1
    assert np.mean(kept[2]) > 0.97  # clean documents stay
    assert np.mean(kept[0]) < 0.3  # poor ones go


def test_toxic_texts_go_whatever_their_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    train, test = labels.where("doc_id % 4 > 0"), labels.where("doc_id % 4 = 0")
    model = quality.fit_model(docs, train)
    assert 0 < model.weights[model.weights > 0].sum() <= quality.PRAISE + 1e-6
    graded = quality.grade_documents(docs.join(test.select("doc_id"), "doc_id", "left_semi"), model)
    got = graded.join(quality.graded(test), F.col("row.doc_id") == F.col("of_doc")).select("grade", "keep", F.col("row.text").alias("text"))
    kept = defaultdict(list)
    for r in got.collect():
        kept[r.grade, len(words(r.text)) >= 200].append(r.keep)
    assert len(kept[1, True]) > 40 and len(kept[1, False]) > 40
    assert np.mean(kept[1, True]) < 0.25 and np.mean(kept[1, False]) < 0.25
    assert np.mean(kept[2, True]) > 0.97 and np.mean(kept[2, False]) > 0.95


def test_quality_odd_rows(odd, none, labels, spark):
    model = quality.fit_model(odd.select("doc_id", "text"), labels)
    rows = quality.grade_documents(odd, model).collect()
    assert len(rows) == len(ODD) and {r.row.row for r in rows} == {"x"}
    assert not any(r.keep for r in rows if not words(r.row.text))
    blank = quality.fit_model(none, labels.limit(0))
    assert all(r.keep == bool(words(r.row.text)) for r in quality.grade_documents(odd, blank).collect())
    assert quality.grade_documents(none, model).count() == 0


# ---- letters that decompose, rows that repeat

def test_letters_before_signs_are_cut_as_the_library_cuts():
    encode, width = token_files.encoder(TOKENS)
    library = Tokenizer.from_file(TOKENS)
    known = [0x130, *range(0x958, 0x960), 0x9DC, 0x9DD, 0x9DF, 0xA33, 0xA36, 0xFB1D, 0x1D15E]
    for c in [*known, *range(0x80, 0x3000, 5), *range(0x3000, 0x110000, 997)]:
        if 0xD800 <= c < 0xE000:
            continue
        for text in (f"a{chr(c)}?.", f"{chr(c)}?!", f"{chr(c)}."):
            got = np.frombuffer(encode(text), f"<u{width}").tolist()
            assert got == library.encode(text, add_special_tokens=False).ids, hex(c)


@pytest.mark.parametrize("doc_id", [7, None])
def test_equal_rows_are_taken_one_by_one(spark, labels, doc_id):
    """One source of 1,000 equal rows beside others: the words taken come within one row of the target."""
    rows = [(doc_id, "three words each", "a")] * 1000 + [(100 + i, f"own text {i}", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    got = mixing.mix_sources(df, labels).groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.count("*").alias("n"))
    for r in got.collect():
        assert abs(r["taken"] - r["target"]) <= 3 and r["n"] in (1000, 300)
    again = mixing.mix_sources(df.repartition(3), labels)
    assert again.groupBy("source").agg(F.sum(F.col("size") * F.col("copies"))).collect() is not None
    assert sorted(r[0] for r in again.select("copies").collect()) == sorted(
        r[0] for r in mixing.mix_sources(df, labels).select("copies").collect())


def test_rows_without_id_draw_by_their_text(spark, labels):
    df = spark.createDataFrame([(None, f"text number {i}", "a") for i in range(200)] + [(1, "x y z", "b")], "doc_id long, text string, source string")
    keys = {r["key"] for r in mixing.mix_sources(df, labels).where("source = 'a'").collect()}
    assert len(keys) == 200


def test_bounded_stretches_keep_the_frequent_ones():
    from stayline.llm.common import Recent

    made = []
    memo = Recent(lambda key: (made.append(key), key * 2)[1], 8)
    assert all(memo[0] == 0 and memo[i] == 2 * i for i in range(1, 100))
    assert made.count(0) == 1 and len(memo) + len(memo.old) <= 8
    whole, small = sentencepiece_fst.PieceTransducer(PIECES), sentencepiece_fst.PieceTransducer(PIECES, stretches=10)
    texts = [f"the word{i} and the other {i * 7}" for i in range(200)]
    assert [small.encode(t) for t in texts] == [whole.encode(t) for t in texts]
    assert len(small.solved) + len(small.solved.old) <= 10


class _Counted(dict):
    asked = 0

    def get(self, *args):
        _Counted.asked += 1
        return super().get(*args)


def test_few_arcs_are_tried_and_pairs_stay_bounded():
    machine, library = sentencepiece_fst.PieceTransducer(PIECES, 300), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    machine.arcs = _Counted(machine.arcs)
    text = "thereingtionstation internationalisation andthansteringes"
    assert machine.shortest_path(machine.normalise(text)) == library.encode(text)
    assert _Counted.asked <= 3.6 * len(text)
    for word in LONG.split(" ")[:3000]:
        assert machine.encode(word) == library.encode(word)
    assert sum(1 for _ in machine.pairs) <= machine.pairs.limit


def test_signs_behind_words_are_encoded_apart():
    encode, width = token_files.encoder(TOKENS)
    library = Tokenizer.from_file(TOKENS)
    letters = [chr(c) for c in range(0x130) if re.match(f"[{token_files.LETTERS}]", chr(c))]
    assert all(normalize("NFC", c) == c and len(c.lower()) == 1 and c.lower().isalpha() for c in letters) and len(letters) > 120
    assert token_files.ENDING.sub(r" \g<0>", "a. b?! 3. c.d e,") == "a . b ?! 3. c.d e ,"
    for text in ("Été... a.b c,\td. <|endoftext|>. x|", "É.\u0301 İ. ×. It's, IT'S! <|ENDOFTEXT|>x.", *(f"{c}{s}{e}" for c in letters for s in ".,*|" for e in ("", " z", "z"))):
        assert np.frombuffer(encode(text), f"<u{width}").tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_batches_hold_inside_only(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    sizes = spark.range(5000, numPartitions=1).mapInArrow(lambda b: (pa.RecordBatch.from_pydict({"n": [x.num_rows]}) for x in b), "n long")
    with common.small_batches(spark, 700):
        assert max(r.n for r in sizes.collect()) <= 700
    assert spark.conf.get(name) == before

"""The pipeline's stages, one after another, against brute force on each stage's own input."""

from collections import Counter, defaultdict

import corpus_pipeline as pipeline
import pytest
import sentencepiece
from conftest import ODD, SF
from pyspark.sql import functions as F
from test_copies import brute_classes
from test_texts import brute_targets

from stayline.llm import line_dedup, mixing, quality
from stayline.llm.common import words
from stayline.llm.text_keys import written
from stayline.llm.token_files import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, docs):
    """Input and output of each stage."""
    out, rows = {}, docs
    for name, stage in pipeline.STAGES:
        after = written(stage(spark, rows, SF), "stage")
        out[name] = (rows, after)
        rows = after
    return out


def test_names_and_columns(stages):
    assert list(stages) == ["quality", "lines", "near copies", "mix", "sentencepiece"]
    assert all(stages[n][1].columns == COLUMNS for n in list(stages)[:4])


def test_rejected_documents_go(spark, stages, labels):
    before, after = stages["quality"]
    model = quality.fit_model(before, labels)
    memo = {b: w for b, w in zip(model.chosen.tolist(), model.weights.tolist())}
    want = set()
    for r in before.collect():
        held = {b for w in set(words(r.text)) for b in quality.buckets(w)}
        z = sum(memo.get(b, 0.0) for b in held)
        if held and quality.sigmoid(z - model.limits[1]) >= quality.KEEP:
            want.add(r.doc_id)
    assert {r.doc_id for r in after.collect()} == want
    clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()} & {r.doc_id for r in before.collect()}
    assert len(clean & want) > 0.95 * len(clean)


def test_lines_of_a_source_go(stages):
    before, after = (x.collect() for x in stages["lines"])
    pages, held = Counter(), Counter()
    for r in before:
        pages[r.source] += 1
        held.update({(r.source, line) for line in (r.text or "").split("\n") if line.strip(" ")})
    got = {r.doc_id: r for r in after}
    for r in before:
        kept = [line for line in r.text.split("\n") if not line.strip(" ") or held[r.source, line] < line_dedup.MIN_PAGES
                or held[r.source, line] <= line_dedup.RATIO * pages[r.source]]
        assert got[r.doc_id].text == "\n".join(kept)
        assert got[r.doc_id].n_chars == (r.n_chars if len(kept) == r.text.count("\n") + 1 else len("\n".join(kept)))


def test_one_of_each_class_stays(stages):
    before, after = (x.collect() for x in stages["near copies"])
    rows = [(r.doc_id, r.text) for r in before]
    assert sorted(r.doc_id for r in after) == sorted(set(brute_classes(rows)))
    assert {r.doc_id: r.text for r in after}.items() <= dict(rows).items()


def test_mix_repeats_documents(spark, stages, labels):
    before, after = (x.collect() for x in stages["mix"])
    size, members = Counter(), defaultdict(list)
    weight = {r.of_doc: r.weight for r in mixing.quality_weights(labels).collect()}
    ids = spark.createDataFrame([(r.doc_id, weight.get(r.doc_id)) for r in before], "doc_id long, w double")
    key = {r.doc_id: r.k for r in ids.select("doc_id", mixing.sampling_key(F.col("doc_id"), F.col("w")).alias("k")).collect()}
    for r in before:
        size[r.source] += len(words(r.text))
        members[r.source].append((key[r.doc_id], r.doc_id, len(words(r.text))))
    target, want = brute_targets(size), Counter()
    for source, rows in members.items():
        epochs = int(target[source] // size[source]) if size[source] else 0
        rest, so_far = target[source] - epochs * size[source], 0
        for _, doc, n in sorted(rows):
            want[doc] += epochs + (so_far < rest and n <= 2 * (rest - so_far))
            so_far += n
    assert Counter(r.doc_id for r in after) == +want


def test_ids_are_the_librarys(stages):
    before, after = (x.collect() for x in stages["sentencepiece"])
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    assert Counter((r.doc_id, tuple(r.ids)) for r in after) == Counter((r.doc_id, tuple(library.encode(r.text))) for r in before)


def test_odd_rows_through_all_stages(spark, odd, none):
    rows = odd
    for name, stage in pipeline.STAGES[1:4]:  # without the classifier, which takes the rows without words
        rows = written(stage(spark, rows, SF), "odd")
        assert rows.columns == odd.columns
    got = rows.collect()
    assert {r.row for r in got} == {"x"} and {r.key for r in got} == {2.0}
    assert not {7, 10} & {r.doc_id for r in got}  # copies of 6 and 9
    for name, stage in pipeline.STAGES:
        none = written(stage(spark, none, SF), "none")
        assert none.count() == 0
    assert len(ODD) == odd.count()


def test_classes_that_share_an_id_stay_apart(spark):
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (5, texts[3]), (5, texts[4]),
            (6, texts[4] + " end"), (7, texts[5]), (None, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.text) for r in pipeline.drop_near_copies(spark, docs, SF).collect())
    assert got == Counter([(None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[3]), (5, texts[4]), (7, texts[5])])

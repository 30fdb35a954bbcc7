"""HTML extraction and neighbour search."""

import re
from collections import defaultdict
from html import unescape

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from stayline.llm import html_model as hm
from stayline.llm import learned_partitions as lp
from stayline.llm.html_tree import parse

# ---- pages

LONG = "some words. " * 30
LAYOUTS = [  # pages in layouts of their own, and their main text
    ("<body><article><h1>T one</h1><p>Some text here is long enough.</p><section class='comments'><p>Great post, thanks a "
     "lot for it.</p><p>I do not agree with this at all, because of many reasons.</p></section></article></body>",
     "T one\nSome text here is long enough."),
    ("<body><header><h1>Site</h1></header><main><h1>T one</h1><p>Some text here is long enough.</p><aside><p>Read also this "
     "other text about things.</p></aside><p>More.</p></main><footer>x</footer></body>",
     "T one\nSome text here is long enough.\nMore."),
    ('<body><div id="top"><a href="/">Home</a> <a href="/b">B</a></div><div><h1>Hello</h1><p>Some text here is long enough. '
     f'It has two sentences.</p><p>{LONG}</p></div><div id="comments"><p>{LONG}</p></div></body>',
     f"Hello\nSome text here is long enough. It has two sentences.\n{LONG.strip()}"),
    ("<body><article><p>One &lt;b&gt; &eacute;&#233;&nbsp;x</p><form><label>Mail</label><input><button>Go</button></form>"
     '<div class="cookie-banner"><p>We use cookies.</p></div><p>Two<br>three</p></article></body>', "One <b> éé x\nTwo three"),
    ("<main><p>Intro:</p><ul><li>one <a href=x>two</a></li><li>three</li></ul></main>", "Intro:\none two\nthree"),
    ("<article><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>a<b>b</b> c<p>d", "ab c\nd"),
]


@pytest.fixture(scope="module")
def model():
    return hm.fit(hm._own_pages())


@pytest.mark.parametrize("page,want", LAYOUTS)
def test_layouts(model, page, want):
    assert model.main_text(page) == want


def test_marginals_are_those_of_all_labellings(model):
    """Sum-product against the sum over every labelling of a small tree."""
    nodes = parse("<body><div class='menu'><p>a b</p></div><div><h1>x</h1><p>some more words. here.</p></div></body>")
    got, n = model.marginals(nodes), len(nodes)
    total, main = 0.0, np.zeros(n)
    for code in range(1 << n):
        label = [code >> i & 1 for i in range(n)]
        weight = np.exp(-6.0) if label[0] else 1.0
        for i, node in enumerate(nodes):
            odds = sum(model.odds.get(f, 0.0) for f in hm.node_features(node, nodes[max(0, node.parent)]))
            weight *= np.exp(odds * label[i])
            if i:
                chance = model.follow[hm.edge_kind(node)][label[node.parent]]
                weight *= chance if label[i] else 1 - chance
        total += weight
        main += weight * np.array(label)
    assert got == pytest.approx((main / total).tolist(), rel=1e-6)


def test_labelled_pages_held_out():
    pages = hm._own_pages()
    fitted = hm.fit([p for i, p in enumerate(pages) if i % 5])
    right = [(chance >= hm.KEEP) == bool(label) for i, (nodes, labels) in enumerate(pages) if i % 5 == 0
             for node, label, chance in zip(nodes, labels, fitted.marginals(nodes)) if node.runs]
    assert np.mean(right) > 0.98


def article(page):
    """The article of a page of the table, cut out by its known tags."""
    start, end = page.find("<article>") + 9, page.find("</article>")
    inner = re.sub(r"<[a-zA-Z/][^>]*$", "", page[start:end if end >= 0 else len(page)])
    parts = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", x)).split())
             for x in re.split(r"</?(?:h1|p)>", inner)]
    return "\n".join(p for p in parts if p)


def test_pages_of_the_table(spark):
    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = hm.op10_html_extraction(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == article(rows[r.page_id]) and r.n_chars == len(r.text)


def test_odd_pages(spark, model):
    kind = "page_id long, url string, html string, text string"
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", "   ", "x"), (None, "u", LAYOUTS[4][0], "x"), (4, "u", "just text", "x"),
            (5, "u", "<article>" + "<p>again</p>" * 5000 + "</article>", "x"), (5, "u", "<<<&&&&amp <a", "x"), (6, "u", "<div " * 500, "x")]
    got = hm.extract_text(spark.createDataFrame(rows, kind).repartition(2), model).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append(r.text)
    assert by[1] == by[2] == by[3] == [""] and by[None] == [LAYOUTS[4][1]]
    assert "\n".join(["again"] * 5000) in by[5]
    assert hm.extract_text(spark.createDataFrame([], kind), model).count() == 0
    assert hm.fit_model(spark.createDataFrame([], kind)).main_text(LAYOUTS[0][0]) == LAYOUTS[0][1]


# ---- vectors

def exact(vectors, asked, k):
    ids = np.array([i for i, _ in vectors])
    x = np.stack([np.asarray(v, float) for _, v in vectors])
    out = {}
    for i, v in vectors:
        if asked(i):
            score = np.add.accumulate(x * np.asarray(v, float), axis=1)[:, -1]
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(frame):
    out = defaultdict(list)
    for r in frame.orderBy("query_id", "rank").collect():
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def test_cells_are_balanced_and_near_vectors_share_them():
    random = np.random.RandomState(0)
    centre = random.standard_normal((16, 32)) * 3
    group = np.repeat(np.arange(16), 64)
    x = centre[group] + random.standard_normal((1024, 32)) * 0.3
    cell = lp.balanced_cells(lp.neighbour_graph(x), 16)
    assert np.bincount(cell).tolist() == [64] * 16
    same = np.mean([np.bincount(cell[group == g]).max() / 64 for g in range(16)])
    assert same > 0.7
    router = lp.fit_router(x, 16)
    assert (router.order(x / np.linalg.norm(x, axis=1).mean())[:, 0] == cell).mean() > 0.7


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    vectors = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = exact(vectors, lambda i: i % 20 == 0, lp.K)
    got = found(lp.op2_learned_partitions(spark, sf))
    assert got.keys() == want.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / lp.K for q in want]
    assert np.mean(hits) >= 0.9
    score = {q: dict(rows) for q, rows in want.items()}
    assert all(s == score[q][i] for q, rows in got.items() for i, s in rows if i in score[q])


def test_clustered_vectors_need_few_cells(spark):
    random = np.random.RandomState(4)
    centre = random.standard_normal((32, 24)) * 2
    x = centre[np.arange(4000) % 32] + random.standard_normal((4000, 24)) * 0.2
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(np.float32).astype(float))], "vec_id long, embedding array<float>")
    got = lp.nearest(rows, F.col("vec_id") % 20 == 0).cache()
    first = got.first()
    assert first.cells >= 8 and first.probes <= first.cells // 2
    want = exact([(i, v) for i, v in enumerate(x.astype(np.float32))], lambda i: i % 20 == 0, lp.K)
    have = found(got)
    assert np.mean([len({i for i, _ in have[q]} & {i for i, _ in want[q]}) / lp.K for q in want]) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), 1.0, -0.5]) for i in range(0, 50)]
    bad = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [nan, 1.0, 1.0]), (180, [inf, 1.0, 1.0]),
           (200, [1.0, 2.0]), (220, []), (None, [1.0, 1.0, 1.0])]
    kind = "vec_id long, embedding array<float>"
    frame = spark.createDataFrame([(*r, "x") for r in good + bad + good[:5]], kind + ", v string").repartition(3)
    got = found(lp.nearest(frame, F.col("vec_id") % 20 == 0))
    assert got == exact(good, lambda i: i % 20 == 0, lp.K)  # ties by id, few candidates, repeated rows
    few = found(lp.nearest(spark.createDataFrame(good[:4], kind), F.col("vec_id") % 20 == 0))
    assert few == exact(good[:4], lambda i: i == 0, lp.K) and len(few[0]) == 3
    assert lp.nearest(spark.createDataFrame([], kind), F.col("vec_id") % 20 == 0).count() == 0
    assert lp.nearest(spark.createDataFrame(good[:1], kind), F.lit(True)).count() == 0

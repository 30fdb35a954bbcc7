"""HTML extraction with a tree-structured graphical model.

Every block element is a node that is main text or not. Node potentials come from what the element shows (tag, words in
class, id and role, amount of text, share of links, sentence ends), parent-child potentials from how labels go together
along an edge; an element that opens a part of the page (a section, or one with marks of its own) binds less to its parent
than a plain paragraph. Messages are passed from the leaves to the document and back (sum-product), which gives the exact
marginal of every node. Text in nodes with a marginal of at least KEEP is the page's main text.

The potentials are fitted by counting on labelled pages: those written out in ``labelled_pages`` and, of at most SAMPLE
pages of the table (first in the hash order of their ids), the ones that mark their main part with an <article> element.

Defined results: a null, empty or text-free page gives empty text; order and repeats of blocks are the page's; a line break
element is a space; an undecodable reference stays as it is.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm.common import slices, table
from stayline.llm.html_tree import Node, block_runs, parse
from stayline.llm.registry import query

KEEP = 0.5
SAMPLE = 400  # pages of the table that may serve as labelled ones
SMOOTH = 0.5
MOST = 0.99  # no edge is surer than this
ROUNDS, RATE = 20, 0.5
PARTS = frozenset("div section article main aside nav header footer form".split())
_LABEL = re.compile(r'data-main="([01])"')


# ------------------------------------------------------------------------------------------------------ potentials

def node_features(node: Node, above: Node) -> list[str]:
    out = [f"t:{node.tag}", f"e:{above.tag}>{node.tag}", *[f"m:{m}" for m in node.marks]]
    if node.tag in PARTS and not node.marks:
        out += [f"bare:{tag}" for tag in sorted(node.holds)] or ["bare"]
    text = "".join(t for _, t in node.runs)
    n = len(text.split())
    if n:
        share = node.linked / max(1, len(text.strip()))
        out += [f"n:{min(4, n.bit_length() // 2)}", f"l:{0 if share < 0.2 else 1 if share < 0.7 else 2}"]
        if "©" in text:
            out.append("copyright")
    return out


def edge_kind(node: Node) -> int:
    """1 for an element that opens a part of the page."""
    return int(node.tag in PARTS or bool(node.marks))


class TreeModel:
    """Log-odds per feature and, per kind of edge and parent label, the chance that a child is main text."""

    def __init__(self, odds: dict[str, float], follow: list[list[float]]):
        self.odds, self.follow = odds, follow

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(main text) of every node, by one pass up and one down the tree."""
        get = self.odds.get
        up = [sum(get(f, 0.0) for f in node_features(node, nodes[max(0, node.parent)])) for node in nodes]  # evidence at and below a node
        told = [0.0] * len(nodes)  # what a node tells its parent
        for i in range(len(nodes) - 1, 0, -1):  # children stand behind their parents
            node = nodes[i]
            not_main, main = self.follow[edge_kind(node)]
            told[i] = _log_ratio(up[i], main, not_main)
            up[node.parent] += told[i]
        belief = [0.0] * len(nodes)
        belief[0] = up[0] - 6.0  # the document itself is not main text
        for i in range(1, len(nodes)):
            node = nodes[i]
            not_main, main = self.follow[edge_kind(node)]
            parent = exp(min(60.0, max(-60.0, belief[node.parent] - told[i])))
            belief[i] = up[i] + log((parent * main + not_main) / (parent * (1 - main) + 1 - not_main))
        return [1 / (1 + exp(-min(60.0, max(-60.0, b)))) for b in belief]

    def main_text(self, page: str | None) -> str:
        if not page:
            return ""
        nodes = parse(page)
        chance = self.marginals(nodes)
        return "\n".join(text for _, node, text in block_runs(nodes) if chance[node] >= KEEP)

    def dump(self) -> str:
        return json.dumps([self.odds, self.follow])

    @classmethod
    def load(cls, text: str) -> TreeModel:
        return cls(*json.loads(text))


def _log_ratio(evidence: float, main: float, not_main: float) -> float:
    """Message to the parent: how much likelier the evidence is under a parent that is main text."""
    x = exp(min(60.0, max(-60.0, evidence)))
    return log((main * x + 1 - main) / (not_main * x + 1 - not_main))


# --------------------------------------------------------------------------------------------------- labelled pages

_WORDS = ("river stone light of the and winter market under quiet road house letter open field glass their was green "
          "morning with paper near bridge for garden between small voice that city rain long over wind").split()


def _text(n: int, seed: int) -> str:
    """Filler sentences of ``n`` words."""
    picked = [_WORDS[(seed * 7 + i * i + 3 * i) % len(_WORDS)] for i in range(n)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(picked)).capitalize() + "."


# Words for the parts of a page, as authors name them
MAIN_PARTS = ["<article>", "<main>", '<div class="content">', '<div id="main-content">', '<div class="post-body">',
              '<section class="story">', "<div>", '<div class="entry-content article-body">', "<div>", '<div itemprop="articleBody">',
              '<div id="text">', '<section>', "<div>", '<div class="article">', '<article class="post">', '<div role="main">']
MENUS = ["<nav>", '<div class="menu">', '<div id="navbar">', '<div class="nav-links">', '<div class="breadcrumbs">',
         '<ul class="navigation">', '<div class="pagination">', '<div class="toc">', '<div class="tags">', '<div class="pager">']
ASIDES = ["<aside>", '<div class="sidebar">', '<div id="right-rail">', '<div class="widget">', '<div class="related">',
          '<aside class="recommended">', '<div class="ad">', '<div class="ads">', '<div class="advert">',
          '<div class="advertisement">', '<div class="sponsored">', '<div class="promo">', '<div class="banner">',
          '<div id="ad-slot">', '<aside class="ad">', '<div class="cookie-notice">', '<div class="notice">',
          '<div id="consent">', '<div class="alert">', '<div class="popup">', '<div class="modal">', '<div class="cookie">',
          '<div class="newsletter">', '<div class="subscribe">', '<div class="signup">', '<div class="share">',
          '<div class="social">', '<div class="disclaimer">', '<div class="privacy">', '<div class="gdpr">', '<div class="teaser">']
REMARKS = ['<div class="comments">', '<section id="comments">', '<ul class="comment-list">', '<div class="replies">',
           '<section class="comments">', '<div class="discussion">', '<div class="reader-comments">', '<div id="disqus">',
           '<div class="comment">', '<ol class="commentlist">', '<div class="reply">', '<section class="responses">']
FORMS = ["<form>", '<form class="search">', '<form id="login">', '<form class="contact">']
HEADS = ["<header>", '<div id="header">', '<div class="masthead">', '<div class="site-header">', '<div class="topbar">']
FEET = ["<footer>", '<div id="footer">', '<div class="copyright">', '<div class="site-footer">', '<footer class="legal">']


def _close(opening: str) -> str:
    return f"</{re.match(r'<([a-z0-9]+)', opening)[1]}>"


def _labelled(opening: str, label: int) -> str:
    return opening.replace(">", f' data-main="{label}">', 1)


def _part(opening: str, inside: str, label: int = 0) -> str:
    return _labelled(opening, label) + inside + _close(opening)


def labelled_pages() -> list[str]:
    """Pages in many layouts; ``data-main`` labels an element and all below it that has no label of its own."""
    pages = []
    others = [*[(m, "menu") for m in MENUS], *[(a, "aside") for a in ASIDES], *[(r, "remark") for r in REMARKS],
              *[(f, "form") for f in FORMS]]
    for i, (main, (other, kind)) in enumerate(product(MAIN_PARTS, others)):
        links = "".join(f'<li><a href="/{k}">{_text(1 + (i + k) % 2, k)}</a></li>' for k in range(4 + i % 5))
        long_ = "".join(f"<p>{_text(8 + (i * k) % 60, i + k)}</p>" for k in range(1 + i % 12))
        inner = {"menu": f"<ul>{links}</ul>", "aside": long_ if i % 3 else _text(6 + i % 40, i), "form":
                 f"<label>{_text(2, i)}</label><p>{_text(7, i)}</p><button>{_text(1, i)}</button>",
                 "remark": "".join(f"<li>{_text(12 + k * 5, i + k)}</li>" if other.startswith(("<ul", "<ol")) else
                                   f"<p>{_text(9 + (k * i) % 70, i + k)}</p>" for k in range(1 + i % 12))}[kind]
        title = f"<h{2 + i % 3}>{_text(1 + i % 3, i)}</h{2 + i % 3}>" if i % 2 and not other.startswith(("<ul", "<ol")) else ""
        extra = _part(other, title + inner)
        body = [f"<h1>{_text(6, i)}</h1>", *[f"<p>{_text(5 + (i * 7 + k * 31) % 90, i + k)}</p>" for k in range(1 + i % 9)]]
        if i % 4 == 1:
            body.append(f"<h2>{_text(3, i)}</h2><ul><li>{_text(9, i)}</li><li>{_text(14, i)}</li></ul>")
        if i % 4 == 2:
            body.append(f"<blockquote>{_text(25, i)}</blockquote><pre>{_text(12, i)}</pre>")
        if i % 4 == 3:
            body.append(f"<table><tr><td>{_text(3, i)}</td><td>{_text(2, i)}</td></tr></table><h3>{_text(4, i)}</h3>")
        if i % 7 == 1:
            body.append(f"<section><h2>{_text(3, i)}</h2><p>{_text(20, i)}</p></section>")
        if i % 7 == 2:
            body[0] = f"<header><h1>{_text(6, i)}</h1></header>"
        if i % 7 == 3:
            body.append(f"<div><p>{_text(11, i)}</p></div><figure><figcaption>{_text(7, i)}</figcaption></figure>")
        if i % 7 == 4:
            body[1:] = [f"<p>{_text(1, i)}</p><ul><li>{_text(2, i)}</li><li>{_text(1, i)}</li></ul>"]
        place = i % 3
        if place == 0:
            body.insert(len(body) // 2 + 1, extra)
        name = [f"<div>{_text(4, i)}</div>", f"<h1>{_text(1 + i % 3, i)}</h1>", f"<p>{_text(5, i)}</p>"][i % 3]
        head = _part(HEADS[(i // 3) % len(HEADS)], name + _part(MENUS[i % len(MENUS)], f"<ul>{links}</ul>"))
        foot = _part(FEET[(i // 2) % len(FEET)], [f"<p>© {_text(5 + i % 9, i)}</p>", f"Copyright {_text(3, i)}", f"<ul>{links}</ul><p>{_text(9, i)}</p>"][i % 3])
        rest = [head if i % 5 else "", extra if place == 1 else "", _part(main, "".join(body), 1), extra if place == 2 else "",
                foot if i % 4 else f"© {_text(6, i)}"]
        wrap = ["{}", "<div>{}</div>", '<div id="wrapper"><div class="container">{}</div></div>', '<div class="page">{}</div>'][(i // 2) % 4]
        pages.append("<html><body>" + wrap.format("".join(rest)) + "</body></html>")
    return pages


def labels_of(nodes: list[Node]) -> list[int]:
    """Labels from ``data-main``, handed down the tree."""
    out = [0] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        own = _LABEL.search(node.attributes)
        out[i] = int(own[1]) if own else out[node.parent]
    return out


def labels_by_article(nodes: list[Node]) -> list[int]:
    """Labels of a page that marks its main part: what is in <article> and in none of the parts named otherwise."""
    out = [0] * len(nodes)
    for i, node in enumerate(nodes[1:], 1):
        inside = node.tag == "article" or out[node.parent] == 1
        out[i] = int(inside and not (edge_kind(node) and node.tag != "article"))
    return out


def fit(pages: list[tuple[list[Node], list[int]]]) -> TreeModel:
    """Parent-child potentials by smoothed counting; node potentials start from counts and climb the likelihood of the
    labels, whose gradient is label minus marginal. So siblings that show the same do not count as so many proofs."""
    seen, total, edges = (Counter(), Counter()), [0, 0], Counter()
    for nodes, labels in pages:
        for i, node in enumerate(nodes):
            total[labels[i]] += 1
            seen[labels[i]].update(set(node_features(node, nodes[max(0, node.parent)])))
            if i:
                edges[edge_kind(node), labels[node.parent], labels[i]] += 1
    odds = {f: log((seen[1][f] + SMOOTH) / (total[1] + 2 * SMOOTH)) - log((seen[0][f] + SMOOTH) / (total[0] + 2 * SMOOTH))
            for f in sorted({*seen[0], *seen[1]})}
    follow = [[min(MOST, max(1 - MOST, (edges[kind, above, 1] + SMOOTH) / (edges[kind, above, 0] + edges[kind, above, 1] + 2 * SMOOTH)))
               for above in (0, 1)] for kind in (0, 1)]
    model = TreeModel(odds, follow)
    for step in range(ROUNDS):
        for nodes, labels in pages:
            for node, label, chance in zip(nodes, labels, model.marginals(nodes)):
                gap = label - chance
                if abs(gap) > 0.01:
                    for f in node_features(node, nodes[max(0, node.parent)]):
                        odds[f] += RATE / (1 + 0.2 * step) * gap
    return model


@lru_cache(maxsize=1)
def _own_pages() -> list[tuple[list[Node], list[int]]]:
    return [(nodes, labels_of(nodes)) for nodes in map(parse, labelled_pages())]


def fit_model(pages: DataFrame, sample: int = SAMPLE) -> TreeModel:
    """Fit on the labelled pages and at most ``sample`` of (page_id, html), in one task; the model reaches the driver."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(_own_pages())
        for batch in batches:
            for page in batch.column(0).to_pylist():
                nodes = parse(page)
                if any(node.tag == "article" for node in nodes):
                    found.append((nodes, labels_by_article(nodes)))
        yield pa.RecordBatch.from_pydict({"model": [fit(found).dump()]})

    ids = pages.where("html is not null and page_id is not null").select(F.col("page_id").alias("chosen"))
    chosen = F.broadcast(ids.orderBy(F.xxhash64("chosen"), "chosen").limit(sample))  # bounded by ``sample``
    rows = pages.join(chosen, F.col("page_id") == F.col("chosen")).select("html").repartition(1).mapInArrow(learn, "model string")
    first = rows.first()
    return TreeModel.load(first["model"]) if first else fit(_own_pages())


@lru_cache(maxsize=2)
def _loaded(model: str) -> TreeModel:
    return TreeModel.load(model)


def extract_text(pages: DataFrame, model: TreeModel) -> DataFrame:
    """(page_id, url, text) of every page; no shuffle."""
    packed = model.dump()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extractor = _loaded(packed)
        for batch in batches:
            for part in slices(batch, 2):
                texts = [extractor.main_text(page.as_py()) for page in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


@query("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages, fit_model(pages)).withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages, by gradient-boosted trees over DOM nodes and hierarchical decoding.

A page becomes a tree of its block elements. Each node is described by its subtree's text, link and tag densities, tokens of its
tag and attributes, depth and siblings, and its parent's share of the page. Boosted trees, trained by Spark on a bounded sample
of pages, give the probability that a node is main text. A pass over the tree then decides subtrees, not single nodes: a node is
in as a whole, out as a whole, or mixed with each child decided by itself, whichever is likelier in sum; so no chosen node
stands below a rejected one, nor a rejected one below a chosen one.

Pages carry no labels. The sample's are made from pages that mark their article, in two ways: as they are, and with
tags made anonymous, so that structure has to do; into both, boilerplate of known kinds is put, made of other parts of the
page.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlake.llm.common import written

#: Pages of the training sample, those of the pages that mark their article whose ids hash lowest, and the largest of them in
#: characters. Where no page of that size does, a tenth or a hundredth as many that are as much larger.
TRAINING_PAGES = 200
TRAINING_CHARS = 30_000
LARGER = (1, 10, 100)
TREES, DEPTH = 16, 4
SEED = 11
TOKENS = 160
#: What a mixed node costs for each unit of its weight, so that a subtree is split for good reasons only.
MIXED = 0.6

# Names of HTML elements.
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "select", "button",
       "annotation", "annotation-xml"}
#: Of these, what runs on to the end of the page if it is not closed, as it does in browsers.
TO_THE_END = {"script", "style", "textarea", "title", "iframe"}
#: These cannot stand in each other: where one starts again, the one before was not closed.
FLAT = {"button", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An element that starts closes open ones of these kinds first, up to the next of the kinds after them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
}
BOILERPLATE = ["comment", "comments", "sidebar", "cookie-notice", "banner", "newsletter", "related", "share", "advert", "ad",
               "promo", "breadcrumb", "menu", "social", "signup", "login", "popup", "widget"]

#: What marks an article, in the order in which pages are looked at: elements, or else roles and names of blocks.
MARKS = ("<(article|main)[\\s>]", "(role|itemprop|id|class)\\s*=")
NAMED = [
    re.compile(rf"(?:^|\s)(?:{kind})\s*=\s*(?:\"(?:[^\"]*\s)?|'(?:[^']*\s)?|)(?:{value})(?=[\s\"'>]|$)", re.IGNORECASE)
    for kind, value in (("itemprop", "articleBody"), ("role", "main"), ("id|class", "article|post|entry|story|content|main"))
]
EDGE = re.compile(rf"</?(?:{'|'.join(sorted(BLOCKS, key=len, reverse=True))}|head|body|html)(?=[\s/>])", re.IGNORECASE)
TAG = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>|[^<]+|<", re.DOTALL
)
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
WORD = re.compile(r"[a-z]+")


@dataclass(eq=False)
class Node:
    tag: str
    attributes: str = ""
    parent: Node | None = None
    children: list = field(default_factory=list)  # nodes, and pieces of text as (text, in a link)
    tags: int = 0


def parse(page: str) -> Node:
    """The tree of block elements. Markup that is not well formed closes what it must, as browsers do."""
    root = at = Node("html")
    links, end = 0, 0
    in_head = False
    never: set[str] = set()  # raw elements that are not closed from here on
    while end < len(page):
        m = TAG.match(page, end)
        end = m.end()
        name = m.group(2)
        if name is None:
            if m.group()[:1] != "<" or m.group() == "<":
                if not in_head:
                    at.children.append((m.group(), links > 0))
            continue
        name, closing = name.lower(), bool(m.group(1))
        if name == "head":
            in_head = not closing
            continue
        if name == "body":
            in_head = False
            if not closing:
                root.attributes += m.group(3)
            continue
        if name == "html":
            continue
        if name in RAW:
            if not closing and not m.group().endswith("/>"):
                again = "(?P<open><)" if name in FLAT else "(?!)"
                stop = None if name in never else re.compile(rf"(?:</{name}\s*>|{again}{name}(?=[\s/>]))", re.IGNORECASE).search(page, end)
                if not stop:
                    never.add(name)
                if stop and page.startswith("</", stop.start()):
                    end = stop.end()
                elif name in TO_THE_END:
                    end = len(page)
                else:
                    edge = EDGE.search(page, end, stop.start() if stop else len(page))
                    end = edge.start() if edge else stop.start() if stop else len(page)
            continue
        if name == "a":
            links = max(0, links - 1) if closing else 1
        at.tags += not closing
        if name in ("br", "hr"):
            at.children.append(("\n", False))
        if name not in BLOCKS or name in VOID:
            if name == "hr":
                at.children.append(Node("hr", parent=at))
            continue
        in_head = False
        links = 0
        if closing:
            up = at
            while up is not root and up.tag != name:
                up = up.parent
            if up is not root:
                at = up.parent
            continue
        if at.tag == "p":
            at = at.parent
        elif name in CLOSES:
            kinds, stops = CLOSES[name]
            up = at
            while up is not root and up.tag not in stops:
                if up.tag in kinds:
                    at = up.parent
                up = up.parent
        node = Node(name, m.group(3), at)
        at.children.append(node)
        at = node
    return root


def _with_text_nodes(root: Node) -> list[Node]:
    """All nodes, parents first. Text beside block elements becomes a node of its own."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        if node.tag == "#text":
            continue
        own = [c for c in node.children if isinstance(c, Node)]
        if own or node is root:
            grouped: list[Node] = []
            for child in node.children:
                if isinstance(child, Node):
                    grouped.append(child)
                elif grouped and grouped[-1].tag == "#text":
                    grouped[-1].children.append(child)
                else:
                    grouped.append(Node("#text", parent=node, children=[child]))
            node.children = [g for g in grouped if g.tag != "#text" or any(t.strip() for t, _ in g.children)]
            stack += reversed(node.children)
    return nodes


def _block(node: Node) -> str:
    return " ".join(entities.unescape("".join(t for t, _ in node.children if isinstance(t, str))).split())


def _is_leaf(node: Node) -> bool:
    return not any(isinstance(c, Node) for c in node.children)


def describe(nodes: list[Node], anonymous: bool = False) -> np.ndarray:
    """A row of features for each node."""
    place = {id(n): i for i, n in enumerate(nodes)}
    n = len(nodes)
    parent = [0] + [place[id(x.parent)] for x in nodes[1:]]
    text, linked, stops, tags, paragraphs, blocks, depth = ([0] * n for _ in range(7))
    for i, node in enumerate(nodes):
        if i:
            depth[i] = depth[parent[i]] + 1
        tags[i] = node.tags + 1
        if _is_leaf(node):
            for piece, in_link in node.children:
                size = len(piece.strip())
                text[i] += size
                linked[i] += size * in_link
                stops[i] += piece.count(". ") + piece.count(",") + piece.count(".\n")
            blocks[i] = int(text[i] > 0)
            paragraphs[i] = int(node.tag == "p")
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        up = parent[i]
        children[up].append(i)
        for x in (text, linked, stops, tags, paragraphs, blocks):
            x[up] += x[i]
    order, longest, alike = [0] * n, [max(text[0], 1)] * n, [1] * n
    for below in children:
        kinds: dict[str, int] = {}
        for k in below:
            kinds[nodes[k].tag] = kinds.get(nodes[k].tag, 0) + 1
        top = max((text[k] for k in below), default=0)
        for at, k in enumerate(reversed(below)):
            order[k], longest[k], alike[k] = at, max(top, 1), kinds[nodes[k].tag]
    siblings = np.array([1] + [len(children[u]) for u in parent[1:]])
    up = np.array(parent)
    text, linked, stops, tags, paragraphs, blocks = (np.array(x, float) for x in (text, linked, stops, tags, paragraphs, blocks))
    total, some, parts = max(text[0], 1.0), np.maximum(text, 1), np.maximum(blocks, 1)
    out = np.zeros((n, 18 + TOKENS), np.float32)
    out[:, :18] = np.column_stack(
        [
            np.minimum(depth, 30),
            np.log1p(text),
            text / tags,
            linked / some,
            text / parts,
            stops / some * 100,
            paragraphs / parts,
            np.log1p(blocks),
            text / total,
            np.log1p(siblings),
            np.array(order) / np.maximum(siblings - 1, 1),
            np.array(alike) / siblings,
            text / np.array(longest),
            text[up] / total,
            linked[up] / some[up],
            text[up] / parts[up],
            paragraphs[up] / parts[up],
            np.arange(n) / n,
        ]
    )
    if not anonymous:
        # Its own tokens and, as others, those of all nodes above.
        own: list[list[str]] = [_tokens(x) for x in nodes]
        above: list[frozenset[int]] = [frozenset()] * n
        for i in range(n):
            if i:
                above[i] = above[parent[i]] | {_column("above " + t) for t in own[parent[i]]}
            out[i, [*above[i], *(_column(t) for t in own[i])]] = 1
    return out


@lru_cache(10_000)
def _column(token: str) -> int:
    return 18 + zlib.crc32(token.encode()) % TOKENS


def _tokens(node: Node) -> list[str]:
    values = [a or b or c for a, b, c in ATTRIBUTE.findall(node.attributes)] if node.attributes else []
    return [f"<{node.tag}>", *WORD.findall(" ".join(values).lower())]


@dataclass(frozen=True)
class Trees:
    """All trees as arrays: feature (-1 at a leaf), threshold or value, and children."""

    roots: np.ndarray
    weights: np.ndarray
    features: np.ndarray
    numbers: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for root, weight in zip(self.roots, self.weights, strict=True):
            at = np.full(len(rows), root)
            for _ in range(DEPTH):
                feature = self.features[at]
                inner = feature >= 0
                goes_left = rows[each, np.maximum(feature, 0)] <= self.numbers[at]
                at = np.where(inner, np.where(goes_left, self.left[at], self.right[at]), at)
            total += weight * self.numbers[at]
        return 2 * total


def decode(nodes: list[Node], margins: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Whether each node is in. Whole subtrees, as likely as possible in sum."""
    margins = np.clip(margins, -6, 6)
    inside, outside = -np.logaddexp(0, -margins) * weights, -np.logaddexp(0, margins) * weights
    place = {id(n): i for i, n in enumerate(nodes)}
    n = len(nodes)
    all_in, all_out, apart = inside.copy(), outside.copy(), np.zeros(n)
    best = np.zeros(n)
    for i in range(n - 1, -1, -1):
        mixed = apart[i] - MIXED * weights[i] if not _is_leaf(nodes[i]) else -np.inf
        best[i] = max(all_in[i], all_out[i], mixed)
        if i:
            up = place[id(nodes[i].parent)]
            all_in[up] += all_in[i]
            all_out[up] += all_out[i]
            apart[up] += best[i]
    state = np.zeros(n, np.int8)  # 1 in, 0 out, 2 mixed
    for i in range(n):
        up = state[place[id(nodes[i].parent)]] if i else 2
        if up != 2:
            state[i] = up
        elif best[i] == all_in[i]:
            state[i] = 1
        elif best[i] == all_out[i]:
            state[i] = 0
        else:
            state[i] = 2
    return state == 1


def _sizes(nodes: list[Node]) -> np.ndarray:
    """Weight of a node in decoding: what it says by itself, not through its children."""
    return np.array([1.0 + math.log1p(sum(len(t) for t, _ in n.children) if _is_leaf(n) else 0) / 4 for n in nodes])


def extract(page: str, trees: Trees) -> str:
    nodes = _with_text_nodes(parse(page))
    if len(nodes) == 1 or all(n.tag == "#text" for n in nodes[1:]):
        return "\n".join(b for n in nodes if _is_leaf(n) and (b := _block(n)))
    chosen = decode(nodes, trees.margin(describe(nodes)), _sizes(nodes))
    return "\n".join(b for n, x in zip(nodes, chosen, strict=True) if x and _is_leaf(n) and (b := _block(n)))


def _put(parent: Node, at: int, tag: str, attributes: str, blocks: list[str], rng: random.Random) -> Node:
    node = Node(tag, attributes, parent)
    inner = rng.choice(["p", "li", "div", ""])
    for text in blocks:
        if inner:
            child = Node(inner, "", node)
            child.children.append((text, rng.random() < 0.3))
            node.children.append(child)
        else:
            node.children.append((text, False))
    parent.children.insert(at, node)
    return node


def _vary(article: Node, rng: random.Random) -> None:
    for child in [c for c in article.children if isinstance(c, Node) and c.tag == "p"]:
        chance, at = rng.random(), next(k for k, c in enumerate(article.children) if c is child)
        words = _block(child).split()
        if chance < 0.12:
            child.tag, child.children = rng.choice(["h2", "h3", "h4"]), [(" ".join(words[: rng.randint(1, 8)]), False)]
        elif chance < 0.24:
            size = rng.randint(2, 15)
            items = [" ".join(words[k : k + size]) for k in range(0, len(words), size)]
            child.tag, child.children = rng.choice(["ul", "ol"]), []
            for item in items:
                point = Node("li", "", child)
                point.children.append((item, rng.random() < 0.1))
                child.children.append(point)
        elif chance < 0.36:
            outer = Node(rng.choice(["div", "section", "blockquote", "figure"]), "", article)
            article.children[at], child.parent = outer, outer
            outer.children.append(child)
        elif chance < 0.42:
            child.children = [(" ".join(words[: rng.randint(1, 4)]), False)]


def _outermost(nodes: list[Node]) -> list[Node]:
    found, inner = {id(n) for n in nodes}, []
    for node in nodes:
        up = node.parent
        while up is not None and id(up) not in found:
            up = up.parent
        inner.append(up is not None)
    return [n for n, x in zip(nodes, inner, strict=True) if not x]


def marked(nodes: list[Node], level: int = 0) -> Node | None:
    """The one article of a page, or else its one main element; on level 1 its one block with a role or name of an article."""
    if not any(_is_leaf(n) and _block(n) for n in nodes):
        return None
    if level:
        kinds = [[n for n in nodes[1:] if n.attributes and x.search(n.attributes)] for x in NAMED]
    else:
        kinds = [[n for n in nodes if n.tag == tag] for tag in ("article", "main")]
    return next((top[0] for kind in kinds if len(top := _outermost(kind)) == 1), None)


def labelled_nodes(page: str, seed: int, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a page's nodes, if it marks one article: as it is, made anonymous, and the article alone.

    Boilerplate is put in, and some of the article's blocks become headings, lists or parts of sections. Articles inside the
    article are comments, by the standard.
    """
    features, labels = [], []
    for form in ("whole", "anonymous", "alone"):
        anonymous, rng = form == "anonymous", random.Random(f"{seed} {form}")
        root = parse(page)
        nodes = _with_text_nodes(root)
        article, added = marked(nodes, level), []
        if article is None:
            break
        texts = [b for n in nodes if _is_leaf(n) and (b := _block(n))]
        if article.tag == "article":
            added += [n for n in nodes if n.tag == "article" and n is not article]
        if form == "alone":
            article.parent, root.children = root, [article]
        _vary(article, rng)
        for _ in range(0 if form == "alone" and rng.random() < 0.5 else rng.randint(1, 5)):
            words = rng.choice(texts).split()
            blocks = [" ".join(words[: rng.randint(1, 60)]) for _ in range(rng.randint(1, 6))]
            kind = rng.choice(BOILERPLATE)
            attributes = rng.choice([f'class="{kind}"', f'id="{kind}"', f'class="box {kind}"'])
            tag = rng.choice(["div", "section", "aside", "form", "header", "ul", "div"])
            parent = rng.choice([article, article.parent])
            added.append(_put(parent, rng.choice([0, len(parent.children)]), tag, attributes, blocks, rng))
        nodes = _with_text_nodes(root)
        state = np.zeros(len(nodes), np.int8)  # 1 article, 0 not, 2 both
        place = {id(n): i for i, n in enumerate(nodes)}
        out = {id(a) for a in added}
        for i, node in enumerate(nodes):
            up = state[place[id(node.parent)]] if i else 0
            state[i] = 0 if id(node) in out else 1 if node is article or form == "alone" and not i else up
        for i in range(len(nodes) - 1, 0, -1):
            up = place[id(nodes[i].parent)]
            if state[i] != state[up]:
                state[up] = 2
        # Children that were not touched keep what they are; an article with boilerplate in it is neither.
        pure = state < 2
        features.append(describe(nodes, anonymous)[pure])
        labels.append(state[pure])
    if not features:
        return np.zeros((0, 18 + TOKENS), np.float32), np.zeros(0, np.int8)
    return np.concatenate(features), np.concatenate(labels)


def sampled(pages: DataFrame, level: int = 0, larger: int = 1) -> DataFrame:
    """hash and html of the pages that mark their article, TRAINING_PAGES // larger of them at most, lowest hashes first.

    The test takes a parsed page, so it is put to the lowest hashes first, then to more, and to all pages if need be.
    """

    @F.pandas_udf("boolean")
    def passes(batch: pd.Series) -> pd.Series:
        return pd.Series([marked(_with_text_nodes(parse(page)), level) is not None for page in batch], dtype=bool)

    whole = pages.filter(F.length("html").between(1, TRAINING_CHARS * larger)).filter(F.lower("html").rlike(MARKS[level]))
    hashed = whole.select(F.xxhash64(F.lit(SEED), "page_id", "html").alias("hash"), "page_id", "html")
    wanted = max(1, TRAINING_PAGES // larger)
    for tried in (wanted, 16 * wanted, 0):
        # Ids first: the pages themselves are looked at only for the few chosen.
        lowest = (hashed if tried else hashed.filter(passes("html"))).select("hash").distinct().orderBy("hash").limit(tried or wanted)
        lowest = written(lowest, "hashes")
        part = hashed.join(F.broadcast(lowest), "hash", "left_semi").dropDuplicates(["hash"]).filter(passes("html"))
        part = written(part.select("hash", "html").orderBy("hash").limit(wanted), "sample")
        if part.count() == wanted or lowest.count() < tried:
            break
    return part


def train(pages: DataFrame) -> Trees | None:
    """Trees from pages that mark their article; None if no page of the table does, by element, role or name."""
    for level in range(len(MARKS)):
        for larger in LARGER:
            sample = sampled(pages, level, larger)
            if not sample.isEmpty():
                return _trained(sample, level)
    return None


def _trained(sample: DataFrame, level: int) -> Trees | None:
    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for seed, page in zip(batch["seed"], batch["html"], strict=True):
                rows, labels = labelled_nodes(page, int(seed), level)
                if len(rows):
                    yield pd.DataFrame({"values": [r.tolist() for r in rows], "label": labels.astype(float)})

    sample = sample.select(F.pmod("hash", F.lit(1 << 31)).alias("seed"), "html").repartition(8)
    rows = written(sample.mapInPandas(label, "values array<double>, label double"), "nodes")
    kinds = {r.label for r in rows.select("label").distinct().collect()}
    if len(kinds) < 2:
        return None
    # At most TRAINING_PAGES pages of TRAINING_CHARS characters: one task, in a fixed order.
    rows = rows.orderBy("label", "values").coalesce(1).select(array_to_vector("values").alias("features"), "label").cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=24, seed=SEED).fit(rows)
    rows.unpersist()
    return _arrays(model)


def _arrays(model) -> Trees:
    features, numbers, left, right, roots = [], [], [], [], []

    def add(node) -> int:
        at = len(features)
        features.append(-1)
        numbers.append(node.prediction())
        left.append(at)
        right.append(at)
        if node.getClass().getSimpleName() == "InternalNode":
            features[at], numbers[at] = node.split().featureIndex(), node.split().threshold()
            left[at], right[at] = add(node.leftChild()), add(node.rightChild())
        return at

    for tree in model.trees:
        roots.append(add(tree._java_obj.rootNode()))
    return Trees(np.array(roots), np.array(model.treeWeights), *map(np.array, (features, numbers, left, right)))


def main_text(pages: DataFrame) -> DataFrame:
    """`pages` with `text`, the main text, and `n_chars`, its code points; both replace columns of the same name.

    A null or empty page has an empty text. A page without any block element is all main text. A page of any length is
    parsed whole; one page at a time is in memory. Repeated rows are extracted each. If no page of the table marks an
    article, nothing can be learnt, and main text is what stands in paragraphs and headings.
    """
    source = pages.withColumn("_html", F.coalesce(F.col("html"), F.lit("")))
    trees = train(source.select("page_id", F.col("_html").alias("html")))
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def text_of(batch: pd.Series) -> pd.Series:
        return pd.Series([_text_of(page, shared.value) for page in batch], dtype=object)

    done = source.withColumn("text", text_of("_html")).drop("_html")
    return done.withColumn("n_chars", F.char_length("text").cast("long"))


def _text_of(page: str, trees: Trees | None) -> str:
    if trees is not None:
        return extract(page, trees)
    nodes = _with_text_nodes(parse(page))
    kept = [n for n in nodes if _is_leaf(n) and n.tag in ("p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6")]
    return "\n".join(b for n in kept if (b := _block(n)))

"""Main text of web pages by a tree-structured graphical model over the DOM.

Block elements are the nodes, each content or not.  A node's potential comes from its
features (hints in tag, class, id and role; link density, length and punctuation of its
text); parent-child potentials are the chance of a label given the parent's label and the
kind of the child (sectioning or flow element).  Both are estimated from labelled pages:
those that mark their main text by landmarks (``article``, ``main``, ``role=main``,
``itemprop=articleBody``); a page without landmarks trains nothing.  Training reads a
bounded sample of about ``TRAIN_PAGES`` pages; pseudo-counts stand for what it does not show.
Sum-product messages run up and down each tree; text blocks of nodes whose content marginal
is above one half are joined in page order.

Null or empty html gives an empty text, as does a page without content.  Broken markup (open
tags, a page cut off) is read as far as it goes; an element whose text is skipped (``RAW``) is skipped to its
own closing tag, and only ``RAW_TEXT`` elements to the end of the page if there is none.  Repeated rows each give a row.
"""

from __future__ import annotations

import html as htmllib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 4000

# Element kinds and hint words.
SECTIONING = set("html body article main section div aside nav header footer form center dialog menu fieldset details".split())
FLOW = set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure "
           "figcaption address hr summary".split())
BLOCKS = SECTIONING | FLOW
RAW = set("script style title textarea noscript iframe xmp noembed noframes svg math template select button object head".split())
# the rest of the page is theirs if they are not closed; of the others only the opening tag is skipped then
RAW_TEXT = set("script style title textarea xmp noembed noframes".split())
VOID = set("br hr img input meta link area base col embed source track wbr param".split())
NEGATIVE_TAGS = set("nav header footer aside form dialog menu fieldset".split())
POSITIVE_TAGS = {"article", "main"}
NEGATIVE_WORDS = set(
    "nav navbar navigation menu header masthead banner footer foot sidebar side aside ad ads adv advert adverts advertisement "
    "sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login form search share sharing social related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager comment comments reply replies respond disqus discussion widget toolbar legal copyright "
    "complementary contentinfo skip hidden teaser outbrain taboola".split())
NEGATIVE_IN_LANDMARKS = set("comment comments reply replies ad ads advert related teaser sponsored promo hidden".split())
POSITIVE_WORDS = set("article content main post entry story body text articlebody maincontent".split())

# attributes: quotes only count right after an equals sign; an apostrophe inside an unquoted value is part of it
ATTRIBUTES = r"(?>[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?>\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+|=)*+"
TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|</?[a-zA-Z][^\s/>]*+{ATTRIBUTES}>|</?[a-zA-Z][^>]*>"
                   r"|<[!?/][^>]*>|<[!?/a-zA-Z][^>]*$|[^<]+|<", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTR = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LANDMARK = re.compile(r"role\s*=\s*[\"']?main|itemprop\s*=\s*[\"']?articleBody", re.I)
WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

# hints: of the element itself, or inherited from the nearest element that has one
NONE, NEGATIVE, POSITIVE, BELOW_NEGATIVE, LAND, BELOW_POSITIVE = range(6)
BELOW = {NEGATIVE: BELOW_NEGATIVE, BELOW_NEGATIVE: BELOW_NEGATIVE, POSITIVE: BELOW_POSITIVE, LAND: BELOW_POSITIVE,
         BELOW_POSITIVE: BELOW_POSITIVE}
FLOW_WEIGHT = 0.25  # of a flow element's text features: it goes with its parent
FEATURES = ("hint", "links", "length", "sentence")


def _ends(tag: str, source: str) -> dict[int, int]:
    """Where each closed element of ``tag`` ends, by where it starts."""
    found, opened = {}, []
    for m in re.finditer(rf"<!--.*?(?:-->|$)|<(script|style|textarea)\b.*?</\1\b[^>]*>|<(/?){tag}(?=[\s/>]){ATTRIBUTES}>",
                         source, re.I | re.S):
        if m.group(2) == "/":
            if opened:
                found[opened.pop()] = m.end()
        elif m.group(2) == "" and not m.group().endswith("/>"):
            opened.append(m.start())
    return found


class Page:
    """Block nodes in page order (parent before child) and the text blocks that they own."""

    def __init__(self, source: str):
        self.tag, self.parent, self.hint, self.landmark = ["html"], [-1], [0], [False]
        self.chars, self.linked, self.sentences = [0], [0], [0]
        self.blocks: list[tuple[int, str]] = []
        self._read(source)
        for i in range(len(self.tag) - 1, 0, -1):  # of the whole subtree
            p = self.parent[i]
            self.chars[p] += self.chars[i]
            self.linked[p] += self.linked[i]
            self.sentences[p] += self.sentences[i]
        # a wrapper with a negative name around the marked main text says nothing about it
        marked = [0] * len(self.tag)  # characters of the largest marked node below
        for i in range(len(self.tag) - 1, 0, -1):
            p = self.parent[i]
            own = self.chars[i] if self.hint[i] in (LAND, POSITIVE) else 0
            marked[p] = max(marked[p], marked[i], own)
            if self.hint[i] == NEGATIVE and 2 * marked[i] > self.chars[i]:
                self.hint[i] = NONE
        for i in range(1, len(self.tag)):
            if self.hint[i] == NONE:
                self.hint[i] = BELOW.get(self.hint[self.parent[i]], NONE)

    def _flush(self, node: int, pieces: list[str], linked: int) -> None:
        if pieces:
            text = " ".join(htmllib.unescape("".join(pieces)).split())
            if text:
                self.blocks.append((node, text))
                self.chars[node] += len(text)
                self.linked[node] += min(linked, len(text))
                self.sentences[node] += sum(text.count(c) for c in ".!?。")
            pieces.clear()

    def _read(self, source: str) -> None:
        stack, pieces, linked, in_link, at, n = [0], [], 0, False, 0, len(source)
        ends: dict[str, dict[int, int]] = {}
        opened: Counter = Counter()  # elements on the stack, the root aside
        while at < n:
            m = TOKEN.match(source, at)
            if m is None:
                break
            tok, at = m.group(), m.end()
            if tok[0] != "<" or tok == "<":
                pieces.append(tok)
                if in_link:
                    linked += len(tok.strip())
                continue
            name = NAME.match(tok)
            if name is None:
                continue  # comment, doctype, processing instruction
            if tok[-1] != ">":
                break  # the page ends inside a tag
            tag, closing = name.group(1).lower(), tok[1] == "/"
            if tag == "a":
                in_link = not closing
            elif tag == "br":
                pieces.append(" ")
            elif tag in RAW:
                if tag not in RAW_TEXT:
                    if not closing and tag != "head":
                        if tag not in ends:
                            ends[tag] = _ends(tag, source)
                        at = ends[tag].get(m.start(), at)
                elif not closing and not tok.endswith("/>"):
                    end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                    at = end.end() if end else n
            elif tag in BLOCKS:
                self._flush(stack[-1], pieces, linked)
                linked, in_link = 0, False
                if closing:
                    if opened[tag]:
                        while True:
                            last = self.tag[stack.pop()]
                            opened[last] -= 1
                            if last == tag:
                                break
                    continue
                if len(stack) > 1 and (self.tag[stack[-1]] == "p" or self.tag[stack[-1]] in CLOSED_BY.get(tag, ())):
                    opened[self.tag[stack.pop()]] -= 1
                if tag in ("html", "body"):
                    continue  # the root stands for both
                self._open(tag, tok, stack)
                opened[tag] += tag not in VOID
        self._flush(stack[-1], pieces, linked)

    def _open(self, tag: str, tok: str, stack: list[int]) -> None:
        words = {w.lower() for a in ATTR.findall(tok) for w in WORD.findall(" ".join(a))}
        landmark = tag in POSITIVE_TAGS or bool(LANDMARK.search(tok))
        if tag in NEGATIVE_TAGS or words & (NEGATIVE_IN_LANDMARKS if landmark else NEGATIVE_WORDS):
            hint = NEGATIVE
        else:
            hint = LAND if landmark else POSITIVE if words & POSITIVE_WORDS else NONE
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.hint.append(hint)
        self.landmark.append(landmark and hint != NEGATIVE)
        for x in (self.chars, self.linked, self.sentences):
            x.append(0)
        if tag not in VOID:
            stack.append(len(self.tag) - 1)

    def features(self, i: int) -> tuple[int, int, int, int]:
        n, l = self.chars[i], self.linked[i]
        share = 0 if n == 0 else 1 if 3 * l < n else 2 if 3 * l < 2 * n else 3
        size = 0 if n == 0 else 1 if n < 40 else 2 if n < 200 else 3
        return self.hint[i], share, size, min(self.sentences[i], 2)

    def kind(self, i: int) -> int:
        return int(self.tag[i] in FLOW)

    def labels(self) -> list[int] | None:
        """By landmark: inside one and not inside a boilerplate element below it; None without landmarks."""
        if not any(self.landmark):
            return None
        out = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            out[i] = int((self.landmark[i] or out[self.parent[i]] == 1) and self.hint[i] not in (NEGATIVE, BELOW_NEGATIVE))
        return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c: Counter = Counter()
        for source in b.column(0).to_pylist():
            page = Page(source or "")
            labels = page.labels()
            if labels is None:
                continue
            for i in range(1, len(labels)):
                for f, v in zip(FEATURES, page.features(i)):
                    c[f, v, labels[i]] += 1
                c["edge", page.kind(i) * 2 + labels[page.parent[i]], labels[i]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.int32()),
                                          pa.array([k[2] for k in c], pa.int32()), pa.array(list(c.values()), pa.int64())],
                                         ["name", "value", "label", "n"])


# What is taken for granted beside the counts: (name, value) -> weight in (other, content) of 1000 nodes
PSEUDO = {("hint", NONE): (350, 250), ("hint", NEGATIVE): (300, 2), ("hint", POSITIVE): (10, 150),
          ("hint", BELOW_NEGATIVE): (330, 1), ("hint", LAND): (1, 150), ("hint", BELOW_POSITIVE): (9, 447),
          ("links", 0): (200, 100), ("links", 1): (300, 820), ("links", 2): (100, 60), ("links", 3): (400, 20),
          ("length", 0): (100, 50), ("length", 1): (450, 150), ("length", 2): (300, 300), ("length", 3): (150, 500),
          ("sentence", 0): (600, 200), ("sentence", 1): (200, 300), ("sentence", 2): (200, 500),
          # sectioning below other / content, flow below other / content
          ("edge", 0): (800, 200), ("edge", 1): (100, 900), ("edge", 2): (995, 5), ("edge", 3): (5, 995)}


def train(pages: DataFrame, sample_pages: int = TRAIN_PAGES) -> dict:
    """Log potentials from a sample of pages chosen by hash (all pages if there are fewer)."""
    total = pages.count()
    every = max(1, total // sample_pages)
    sample = pages.filter(F.pmod(F.xxhash64("html"), F.lit(every)) == 0).select("html")
    rows = sample.mapInArrow(_counts, "name string, value int, label int, n long").groupBy("name", "value", "label").agg(
        F.sum("n").alias("n")).collect()  # a few dozen numbers
    counts = {(r["name"], r["value"], r["label"]): r["n"] for r in rows}
    model: dict = {}
    for name in FEATURES:
        values = [v for f, v in PSEUDO if f == name]
        for label in (0, 1):
            seen = sum(counts.get((name, v, label), 0) for v in values)
            scale = 1000 / max(seen, 1)  # the sample weighs as much as the pseudo-counts
            tot = sum(PSEUDO[name, v][label] + scale * counts.get((name, v, label), 0) for v in values)
            for v in values:
                model[name, v, label] = math.log((PSEUDO[name, v][label] + scale * counts.get((name, v, label), 0)) / tot)
    for v in range(4):
        seen = sum(counts.get(("edge", v, x), 0) for x in (0, 1))
        scale = 1000 / max(seen, 1)
        w = [PSEUDO["edge", v][x] + scale * counts.get(("edge", v, x), 0) for x in (0, 1)]
        for x in (0, 1):
            model["edge", v, x] = math.log(w[x] / sum(w))
    return model


def marginals(page: Page, model: dict) -> list[float]:
    """P(content) of every node by one upward and one downward pass of messages."""
    n = len(page.tag)
    # the root is seldom content, unless the page has no sections at all
    unary = [[0.0, -3.0 if any(not page.kind(i) for i in range(1, n)) else 0.5]] + [[sum(model[f, v, x] * (FLOW_WEIGHT if page.kind(i) and f != "hint" else 1) for f, v in zip(FEATURES, page.features(i)))
                               for x in (0, 1)] for i in range(1, n)]
    edge = [None] + [[[model["edge", page.kind(i) * 2 + p, x] for x in (0, 1)] for p in (0, 1)] for i in range(1, n)]

    def add(a: float, b: float) -> float:
        m = max(a, b)
        return m + math.log1p(math.exp(min(a, b) - m))

    below = [u[:] for u in unary]  # own potential and messages from the children
    up = [None] * n
    for i in range(n - 1, 0, -1):
        up[i] = [add(below[i][0] + edge[i][p][0], below[i][1] + edge[i][p][1]) for p in (0, 1)]
        p = page.parent[i]
        below[p][0] += up[i][0]
        below[p][1] += up[i][1]
    belief = [below[0]] + [None] * (n - 1)
    for i in range(1, n):
        p = page.parent[i]
        rest = [belief[p][x] - up[i][x] for x in (0, 1)]
        down = [add(rest[0] + edge[i][0][x], rest[1] + edge[i][1][x]) for x in (0, 1)]
        m = max(below[i][0] + down[0], below[i][1] + down[1])
        belief[i] = [below[i][x] + down[x] - m for x in (0, 1)]
    return [1 / (1 + math.exp(min(700.0, b[0] - b[1]))) for b in belief]


def main_text(source: str, model: dict) -> str:
    page = Page(source)
    if not page.blocks:
        return ""
    p = marginals(page, model)
    return " ".join(t for i, t in page.blocks if p[i] > 0.5)


def extract(pages: DataFrame, model: dict | None = None) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    model = train(pages) if model is None else model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(s or "", model) for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")

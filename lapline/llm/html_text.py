"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks (runs of text with no block tag inside) with the tags, class and id words above
them.  Features are those ancestors and the text's length, links, marks and place; the chain weighs neighbours'
labels.  It is trained by the exact likelihood (forward-backward) on labelled pages and decoded by Viterbi.
"""

from __future__ import annotations

import bisect
import functools
import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm._common import arrow_batches
from lapline.llm.labelled_pages import labelled_pages

ROUNDS, RATE, PENALTY = 80, 0.15, 2e-5  # training: full-batch Adam
LEAST_BLOCKS = 5  # training blocks that have a feature at least

# HTML elements by their part in the page's layout.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe input label legend li main menu
nav object ol optgroup option p pre search section select summary table tbody td template tfoot th thead tr ul video audio ins""".split())
ZONES = frozenset("article aside footer form header main nav section figure blockquote table".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK_TAGS - frozenset("button label option optgroup input ins object video audio iframe".split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIERS = frozenset("ul ol dl table select body html".split())

VALUE = r"=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s<>\"'][^\s<>]*+)?+"  # a quote opens a value only after "=", and only if it closes
ATTRIBUTES = rf"(?:[^<>=]++|{VALUE})*+"


def _token(attributes: str) -> str:
    """Comments, raw elements (1: name) with their content, tags (2: slash, 3: name, 4: attributes), other marks, text."""
    return (r"<!--(?:-?>|.*?(?:--!?>|\Z))"
            rf"|<svg(?=[\s/>])(?:[^<>=/]++|{VALUE}|/(?!>))*+/>"
            rf"|<(script|style|textarea|title|noscript|iframe|xmp|svg|template)(?=[\s/>]){attributes}>.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)"
            rf"|<(/?)([a-zA-Z][^\s/<>]{{0,40}}+)({attributes})>"
            r"|<[!?/][^<>]*+>")


TOKEN = re.compile(_token(ATTRIBUTES) + rf"|(</?[a-zA-Z]{ATTRIBUTES})|[^<]++|<", re.S | re.I)  # 5: a tag that does not end
PLAIN_TOKEN = re.compile(_token("[^<>]*+") + r"|[^<]++|<", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


def _tokens(page: str) -> Iterator[re.Match]:
    """Where quotes leave a tag without an end, they count as ordinary characters up to there.  No part is read more
    than a few times."""
    at = 0
    while True:
        for m in TOKEN.finditer(page, at):
            if m.group(5) is not None:
                break
            yield m
        else:
            return
        upto = m.end()
        for m in PLAIN_TOKEN.finditer(page, m.start()):
            if m.start() >= upto:
                at = m.start()
                break
            yield m
        else:
            return


class Element:
    """An open element: its marks (tag, class and id words) and the last two block tags and zones down to it.

    ``fresh`` names the marks that no ancestor has, so that a chain is known from its parent's in steps that do not grow
    with its depth.  A page has one object for equal chains.
    """

    __slots__ = ("above", "tag", "marks", "tags", "zones", "fresh")

    def __init__(self, above: Element | None, marks: tuple, held: dict[str, int]):
        self.above, self.marks = above, marks
        self.tag = marks[0] if marks else ""
        self.tags, self.zones = (above.tags, above.zones) if above else ((), ())
        if self.tag in BLOCK_TAGS:
            self.tags = (*self.tags[-1:], self.tag)
        if self.tag in ZONES:
            self.zones = (*self.zones[-1:], self.tag)
        self.fresh = ["has:" + m for m in dict.fromkeys(marks) if m not in ("html", "body") and not held.get(m)]


class Chain:
    """The open elements of a page, with the places of every tag, so that no step looks through the chain."""

    def __init__(self):
        self.root = Element(None, (), {})
        self.stack: list[Element] = []
        self.known: dict[tuple[int, tuple], Element] = {}
        self.held: dict[str, int] = {}  # open marks
        self.places: dict[str, list[int]] = {}  # of a tag, rising
        self.blocks: list[int] = []
        self.barriers: list[int] = []

    @property
    def top(self) -> Element:
        return self.stack[-1] if self.stack else self.root

    def push(self, marks: tuple) -> None:
        top, at = self.top, len(self.stack)
        element = self.known.get((id(top), marks))
        if element is None:
            element = self.known[id(top), marks] = Element(top, marks, self.held)
        self.stack.append(element)
        for mark in marks:
            self.held[mark] = self.held.get(mark, 0) + 1
        self.places.setdefault(element.tag, []).append(at)
        if element.tag in BLOCK_TAGS:
            self.blocks.append(at)
        if element.tag in BARRIERS:
            self.barriers.append(at)

    def pop(self, to: int) -> bool:
        """Close the elements from place ``to`` on; true if a link was among them."""
        link = False
        while len(self.stack) > to:
            element = self.stack.pop()
            link |= element.tag == "a"
            for mark in element.marks:
                self.held[mark] -= 1
            self.places[element.tag].pop()
            for places in (self.blocks, self.barriers):
                if places and places[-1] == len(self.stack):
                    places.pop()
        return link

    def ended_by(self, tag: str) -> int | None:
        """Place of the element that an end tag closes.  An inline end tag does not close a block."""
        places = self.places.get(tag)
        if not places or tag not in BLOCK_TAGS and self.blocks and self.blocks[-1] > places[-1]:
            return None
        return places[-1]

    def cut_by(self, tag: str) -> int | None:
        """Place from which a start tag closes elements: an open paragraph, or items of its own list or table."""
        ends = SELF_CLOSING.get(tag)
        if not ends:
            return self.blocks[-1] if tag in CLOSES_P and self.blocks and self.stack[self.blocks[-1]].tag == "p" else None
        floor = self.barriers[-1] if self.barriers else -1
        found = []
        for name in (*ends, "p") if tag in CLOSES_P else ends:
            places = self.places.get(name, [])
            k = bisect.bisect_right(places, floor)
            found += places[k:k + 1]
        return min(found, default=None)


def leaf_blocks(page: str) -> list[tuple[str, Element, int]]:
    """(text, innermost open element, link characters) of every block with text, in page order.

    Character references are decoded, white space runs are one space.  Comments, scripts, styles, titles and text
    areas hold no text.  Time goes with the page's length, however deep its elements lie.
    """
    blocks: list = []
    chain = Chain()
    parts: list[str] = []
    linked = in_link = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            if "&" in text:
                text = entities.unescape(text)
            text = SPACE.sub(" ", text).strip()
            if text:
                blocks.append((text, chain.top, linked))
            parts.clear()
            linked = 0

    def pop(to: int | None) -> None:
        nonlocal in_link
        if to is not None and chain.pop(to):
            in_link = 0

    for m in _tokens(page):
        raw, shut, tag, attributes = m.group(1, 2, 3, 4)
        if tag is None:
            if raw is None and m.group()[0] != "<" or m.group() == "<":
                parts.append(m.group())
                if in_link:
                    linked += len(m.group().strip())
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS:
            close()
        if shut:
            pop(chain.ended_by(tag))
            continue
        if tag in VOID_TAGS:
            parts.append(" ")
            continue
        if tag in CLOSES_P or tag in SELF_CLOSING:
            pop(chain.cut_by(tag))
        if attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        marks = (tag,)
        if "=" in attributes:
            marks += tuple(["." + w for found in ATTRIBUTE.findall(attributes) for w in NAME_WORD.findall("".join(found).lower())])
        chain.push(marks)
        if tag == "a":
            in_link = 1
    close()
    return blocks


def own_features(blocks: list) -> Iterator[list[str]]:
    """Names of the features of every block, but for the marks of its ancestors."""
    n, before = len(blocks), None
    for i, (text, element, linked) in enumerate(blocks):
        size = len(text)
        words = text.count(" ") + 1
        tags, zones = element.tags, element.zones or ("none",)
        names = ["leaf:" + (tags[-1] if tags else "none"), "in:" + "/".join(tags), "zone:" + zones[-1], "zones:" + "/".join(zones),
                 f"words:{min(9, int(math.log2(words)))}", f"links:{round(4 * min(1.0, linked / size))}",
                 "end:" + ("stop" if text[-1] in ".!?…" else "mark" if not text[-1].isalnum() else "word"),
                 f"commas:{min(3, text.count(','))}", f"place:{int(5 * i / n)}", f"stops:{min(3, text.count('. '))}", "bias"]
        if "©" in text:
            names.append("sign")
        if element is before:
            names.append("same")
        before = element
        yield names


def page_features(blocks: list) -> list[list[str]]:
    """Names of all features of every block (for training; :meth:`Labeller.label` adds up a chain only once)."""
    out = []
    for (_, element, _), names in zip(blocks, own_features(blocks)):
        while element is not None:
            names += element.fresh
            element = element.above
        out.append(names)
    return out


class Labeller:
    """The trained chain: weights of features for label 1 over label 0, transitions, and first labels."""

    def __init__(self, weights: dict[str, float], step: np.ndarray, first: np.ndarray):
        self.weights, self.step, self.first = weights, step, first
        self.rows = step.tolist()

    def decode(self, features: list[list[str]]) -> list[int]:
        """Viterbi: the most probable labels."""
        return self.best([sum([self.weights.get(name, 0.0) for name in names]) for names in features])

    def label(self, blocks: list) -> list[int]:
        """Labels of the blocks of a page; the weights of a chain of ancestors are added up once."""
        weights, chains, score = self.weights, {None: 0.0}, []
        for (_, element, _), names in zip(blocks, own_features(blocks)):
            path, at = [], element
            while at not in chains:
                path.append(at)
                at = at.above
            for e in reversed(path):
                chains[e] = chains[e.above] + sum([weights.get(name, 0.0) for name in e.fresh])
            score.append(chains[element] + sum([weights.get(name, 0.0) for name in names]))
        return self.best(score)

    def best(self, score: list[float]) -> list[int]:
        """The most probable labels, given each block's score of label 1 over label 0."""
        if not score:
            return []
        r0, r1 = self.rows
        back: list[tuple[int, int]] = []
        a, b = float(self.first[0]), float(self.first[1]) + score[0]
        for s in score[1:]:
            to0, to1 = (r0[0] + a, r1[0] + b), (r0[1] + a, r1[1] + b)
            back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
            a, b = max(to0), max(to1) + s
        label = int(b > a)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = ROUNDS) -> Labeller:
    """Maximum likelihood with a squared penalty.  Pages are padded to a common length and run together."""
    pages = [p for p in pages if p[1]]
    counts = Counter(name for features, _ in pages for names in features for name in names)
    index = {name: i for i, name in enumerate(sorted(n for n, c in counts.items() if c >= LEAST_BLOCKS))}
    longest = max((len(y) for _, y in pages), default=0)
    if not longest:
        raise ValueError("no labelled block")
    mask = np.zeros((longest, len(pages)), bool)
    gold = np.zeros((longest, len(pages)), np.int64)
    at, of = [], []
    for j, (features, labels) in enumerate(pages):
        mask[:len(labels), j], gold[:len(labels), j] = True, labels
        for i, names in enumerate(features):
            got = [index[n] for n in names if n in index]
            of += got
            at += [i * len(pages) + j] * len(got)
    at, of = np.array(at), np.array(of)
    n_features, blocks = len(index), mask.sum()
    theta = np.zeros(n_features + 6)
    first_moment, second_moment = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, step, start = theta[:n_features], theta[n_features:n_features + 4].reshape(2, 2), theta[n_features + 4:]
        s = np.bincount(at, w[of], mask.size).reshape(mask.shape)
        emit = np.stack([np.zeros_like(s), s], axis=2)
        alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
        alpha[0] = start + emit[0]
        for t in range(1, longest):
            alpha[t] = np.where(mask[t, :, None], np.logaddexp.reduce(alpha[t - 1][:, :, None] + step, axis=1) + emit[t], alpha[t - 1])
        for t in range(longest - 2, -1, -1):
            beta[t] = np.where(mask[t + 1, :, None], np.logaddexp.reduce(step + (emit[t + 1] + beta[t + 1])[:, None, :], axis=2), beta[t + 1])
        z = np.logaddexp.reduce(alpha[-1], axis=1)
        p = np.exp(alpha + beta - z[:, None])
        delta = np.where(mask, p[:, :, 1] - gold, 0.0)
        g = np.zeros_like(theta)
        g[:n_features] = np.bincount(of, delta.reshape(-1)[at], n_features)
        pair = np.exp(alpha[:-1, :, :, None] + step + (emit[1:] + beta[1:])[:, :, None, :] - z[:, None, None])
        pair = np.where(mask[1:, :, None, None], pair, 0.0).sum(axis=(0, 1))
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[:-1][mask[1:]], gold[1:][mask[1:]]), 1)
        g[n_features:n_features + 4] = (pair - seen).reshape(-1)
        g[n_features + 4:] = p[0].sum(axis=0) - np.bincount(gold[0], minlength=2)
        g = g / blocks + PENALTY * theta
        first_moment = 0.9 * first_moment + 0.1 * g
        second_moment = 0.999 * second_moment + 0.001 * g * g
        theta -= RATE * (first_moment / (1 - 0.9 ** k)) / (np.sqrt(second_moment / (1 - 0.999 ** k)) + 1e-8)
    named = {name: float(theta[i]) for name, i in index.items()}
    return Labeller(named, theta[n_features:n_features + 4].reshape(2, 2), theta[n_features + 4:])


@functools.cache
def default_labeller() -> Labeller:
    """Trained on the pages of :mod:`labelled_pages`; once a process."""
    examples = []
    for page, labels in labelled_pages():
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise AssertionError("a labelled page reads otherwise than it was written")
        examples.append((page_features(blocks), labels))
    return train(examples)


def main_blocks(page: str | None, labeller: Labeller) -> list[str]:
    blocks = leaf_blocks(page) if page else []
    return [b[0] for b, label in zip(blocks, labeller.label(blocks)) if label]


def extract(pages: DataFrame, html_col: str = "html", labeller: Labeller | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but the html) with ``text``, the main blocks joined by line feeds, and
    ``blocks``, their number.  Null, empty and textless pages give an empty text; every row is read whole, and
    rows that repeat are extracted alike."""
    arrow_batches(pages.sparkSession, 500)
    labeller = labeller or default_labeller()
    names = [c for c in pages.columns if c != html_col] if keep is None else keep
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(html_col).cast("string").alias("html"))
    kind = rows.schema["row"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_blocks(x.as_py(), labeller) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(["\n".join(x) for x in found], pa.string()), pa.array([len(x) for x in found], pa.int32())],
                                             names=["row", "text", "blocks"])

    out = rows.mapInArrow(read, f"row {kind}, text string, blocks int")
    return out.select(*[F.col(f"row.`{c}`") for c in names if c not in ("text", "blocks")], "text", "blocks")

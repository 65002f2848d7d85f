"""HTML main-text extraction by a linear-chain conditional random field.

A page is read into leaf blocks: runs of text between block-level tags, each
with its open elements.  Features of a block are its ancestors' tags, the words
in their class and id, and the form of its text; transitions tell whether a
block shares its container with the one before it.  The model is trained by
gradient ascent on the likelihood of labelled pages (``html_training``) and the
best labelling of each page is decoded by Viterbi.

Comments, scripts, styles, templates and the like never give text.  A self-closed
svg is empty; after the other names the slash counts for nothing, as in HTML, and
an element whose name only begins like theirs is read as any other.  Character
references are decoded; white space inside a block becomes one space; blocks are
joined in page order by a line break.

Defined results: a null or empty html, or a page without article blocks, gives
an empty text; a null page_id or url is kept; repeated rows are read alike; an
empty table gives no rows; a very long page is read whole, in time and memory that
grow with its length, however its tags nest or stay open; of two labellings of the
same score the one with more furniture, from the end, is taken; other columns are
not read."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acctpulse.llm.common import append_columns
from acctpulse.llm.html_training import labelled_pages

_SKIPPED = "script|style|noscript|template|svg|iframe|object|textarea"
# A quote opens a value only after "="; elsewhere it is stray and the tag ends at the next ">".  A last "/" is left over.
_ATTRIBUTES = (
    r"(?:[^>=\"'/]++|=\s*+(?:\"[^\"]*\"|'[^']*'|(?:[^\s>/\"']|/(?!\s*>))(?:[^\s>/]|/(?!\s*>))*+)|[=\"']|/(?!\s*>))*+")
_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/>]){_ATTRIBUTES}/\s*>"
    rf"|<({_SKIPPED})(?=[\s/>]){_ATTRIBUTES}/?\s*>.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES}/?)\s*>", re.S | re.I)
_UNCLOSED = re.compile(r"<[!?].*\Z|(\Z)(\Z)(\Z)(\Z)", re.S)  # after the last ">" nothing else can be a tag
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input".split())
_CONTAINERS = frozenset("article main section div aside nav header footer form body ul ol table".split())


_ITEMS = frozenset("li tr td th dt dd option".split())
_NOTHING: frozenset[str] = frozenset()
PADDED = 1 << 17   # places that the pages decoded together may have, padding included


class Element:
    """An open element with what it and its ancestors say; what adds nothing shares its parent's sets."""

    __slots__ = ("tag", "tags", "names", "own", "container", "main", "linked", "nearest")

    def __init__(self, tag: str, names: frozenset[str], main: bool, number: int, parent: "Element | None", place: int, known: dict | None):
        above = parent.tags if parent else _NOTHING
        counts = tag not in above and (known is None or f"in:{tag}" in known)
        self.tag, self.tags = tag, above | {tag} if counts else above
        above = parent.names if parent else _NOTHING
        self.names = above if names <= above else above | names
        self.own = tag if tag not in _INLINE else parent.own if parent else ""
        self.container = number if tag in _CONTAINERS else parent.container if parent else 0
        self.main = main or bool(parent and parent.main)
        self.linked = tag == "a" or bool(parent and parent.linked)
        # the places of the open paragraph and items that the next block may close, up to the nearest container
        self.nearest = {} if tag in _CONTAINERS or not parent else parent.nearest
        if tag == "p" or tag in _ITEMS:
            self.nearest = {**self.nearest, tag: place}


_ROOT = Element("", _NOTHING, False, 0, None, -1, {})


class Block:
    __slots__ = ("text", "linked", "inside")

    def __init__(self, text: str, linked: int, inside: Element):
        self.text, self.linked, self.inside = text, linked, inside

    @property
    def container(self) -> int:
        return self.inside.container

    @property
    def main(self) -> bool:
        return self.inside.main


def _tags(page: str):
    """The tags, comments and skipped elements of a page; each character is looked at a bounded number of times."""
    last, at = page.rfind(">"), 0
    while (at := page.find("<", at)) >= 0:
        m = (_TAG if at < last else _UNCLOSED).match(page, at)
        if m:
            yield m
        at = m.end() if m else at + 1


def blocks(page: str, known: dict | None = None) -> list[Block]:
    """The leaf blocks of a page, in order; with ``known`` features, only those are kept of tags and names."""
    out: list[Block] = []
    stack: list[Element] = []
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    linked = number = at = 0
    owner: Element | None = None

    def top() -> Element:
        return stack[-1] if stack else _ROOT

    def close(k: int) -> None:
        opened.subtract(e.tag for e in stack[k:])
        del stack[k:]

    def text(raw: str) -> None:
        nonlocal linked, owner
        if raw:
            if not raw.isspace():
                owner = owner or top()
                if top().linked:
                    linked += len(raw.strip())
            pieces.append(raw)

    def flush() -> None:
        nonlocal linked, owner
        if pieces:
            whole = " ".join(references.unescape("".join(pieces)).split())
            if whole:
                out.append(Block(whole, linked, owner or top()))
            pieces.clear()
        linked, owner = 0, None

    for m in _tags(page):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            pieces.append(" ")
        if m[2]:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag))
        elif tag not in _VOID:
            if tag not in _INLINE:  # a block ends an open paragraph, and an item the item before it
                nearest = top().nearest
                k = max(nearest.get("p", -1), nearest.get(tag, -1) if tag in _ITEMS else -1)
                if k >= 0:
                    close(k)
            number += 1
            attributes = m[4] or ""
            names = frozenset(w for found in _NAMED.findall(attributes) for w in _WORD.findall(" ".join(found).lower())
                              if known is None or f"name:{w}" in known) if "=" in attributes else _NOTHING
            if not (m[4] or "").rstrip().endswith("/"):
                stack.append(Element(tag, names, "data-main" in attributes, number, top(), len(stack), known))
                opened[tag] += 1
    text(page[at:])
    flush()
    return out


def block_features(b: Block) -> list[str]:
    n = len(b.text)
    share = b.linked / n
    last = b.text[-1]
    return [
        "bias", f"own:{b.inside.own}", *(f"in:{t}" for t in b.inside.tags), *(f"name:{w}" for w in b.inside.names),
        f"size:{min(n.bit_length(), 10)}", f"links:{0 if share == 0 else 1 if share < 0.5 else 2}",
        f"ends:{'stop' if last in '.!?…' else 'letter' if last.isalpha() else 'other'}",
        "mark:copyright" if "©" in b.text else "mark:none", f"commas:{min(b.text.count(','), 3)}",
    ]


class ChainField:
    """Two labels (0 furniture, 1 article); pages are padded to a common length."""

    def __init__(self):
        self.features: dict[str, int] = {}
        self.emit = np.zeros((0, 2))
        self.move = np.zeros((2, 2, 2))  # same container as before, label before, label

    def _rows(self, page: list[Block], grow: bool = False) -> list[list[int]]:
        if grow:
            return [[self.features.setdefault(f, len(self.features)) for f in block_features(b)] for b in page]
        get = self.features.get
        return [[i for f in block_features(b) if (i := get(f)) is not None] for b in page]

    @staticmethod
    def _pad(pages: list[list[Block]]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each place has a block, and whether it shares its container with the one before."""
        longest = max(map(len, pages))
        there, same = np.zeros((len(pages), longest), bool), np.zeros((len(pages), longest), int)
        for i, page in enumerate(pages):
            there[i, : len(page)] = True
            for t in range(1, len(page)):
                same[i, t] = page[t].container == page[t - 1].container
        return there, same

    def _scores(self, rows: list[list[list[int]]], longest: int) -> np.ndarray:
        out = np.zeros((len(rows), longest, 2))
        flat = [i for page in rows for row in page for i in row]
        size = [len(row) for page in rows for row in page]
        if flat:
            start = np.cumsum(size) - size
            total = np.add.reduceat(self.emit[flat], start)
            k = 0
            for i, page in enumerate(rows):
                out[i, : len(page)] = total[k : k + len(page)]
                k += len(page)
        return out

    def train(self, pages: list[str], epochs: int = 80, rate: float = 0.1, decay: float = 0.002) -> "ChainField":
        parsed = [p for p in map(blocks, pages) if p]
        rows = [self._rows(p, grow=True) for p in parsed]
        self.emit = np.zeros((len(self.features), 2))
        there, same = self._pad(parsed)
        n, longest = there.shape
        label = np.zeros((n, longest), int)
        for i, p in enumerate(parsed):
            label[i, : len(p)] = [b.main for b in p]
        place = [(i, t) for i, page in enumerate(rows) for t, row in enumerate(page) for _ in row]
        at_page, at_time = np.array(place).T
        which = np.array([f for page in rows for row in page for f in row])
        truth = np.eye(2)[label] * there[..., None]
        params, mean, var = [self.emit, self.move], [0.0, 0.0], [0.0, 0.0]
        for step in range(1, epochs + 1):
            score = self._scores(rows, longest)
            ahead = np.zeros((n, longest, 2))
            ahead[:, 0] = score[:, 0]
            for t in range(1, longest):
                move = self.move[same[:, t]]
                new = score[:, t] + np.logaddexp(ahead[:, t - 1, 0, None] + move[:, 0], ahead[:, t - 1, 1, None] + move[:, 1])
                ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
            total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
            back = np.zeros((n, longest, 2))
            expect_move = np.zeros((2, 2, 2))
            for t in range(longest - 1, 0, -1):
                move = self.move[same[:, t]]
                onward = score[:, t] + back[:, t]
                pair = np.exp(ahead[:, t - 1, :, None] + move + onward[:, None, :] - total[:, None, None]) * there[:, t, None, None]
                np.add.at(expect_move, same[:, t], pair)
                hit = there[:, t]
                np.subtract.at(expect_move, (same[hit, t], label[hit, t - 1], label[hit, t]), 1)
                new = np.logaddexp(move[:, :, 0] + onward[:, None, 0], move[:, :, 1] + onward[:, None, 1])
                back[:, t - 1] = np.where(there[:, t, None], new, back[:, t])
            belief = np.exp(ahead + back - total[:, None, None]) * there[..., None]
            gap = (truth - belief)[at_page, at_time]
            grad_emit = np.zeros_like(self.emit)
            np.add.at(grad_emit, which, gap)
            for k, g in enumerate((grad_emit / n - decay * self.emit, -expect_move / n - decay * self.move)):
                mean[k] = 0.9 * mean[k] + 0.1 * g
                var[k] = 0.99 * var[k] + 0.01 * g * g
                params[k] += rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(var[k] / (1 - 0.99**step)) + 1e-8)
        return self

    def decode(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """The best labels of each page."""
        out = [np.zeros(0, int)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:  # pages of like length together, at most PADDED places or one page
            size = 1
            while size < min(128, len(order)) and (size + 1) * len(pages[order[size]]) <= PADDED:
                size += 1
            own, order = order[:size], order[size:]
            group = [pages[i] for i in own]
            there, same = self._pad(group)
            score = self._scores([self._rows(p) for p in group], there.shape[1])
            best, came = score[:, 0].copy(), np.zeros((*there.shape, 2), int)
            for t in range(1, there.shape[1]):
                through = best[:, :, None] + self.move[same[:, t]]
                came[:, t] = np.where(there[:, t, None], through.argmax(axis=1), np.arange(2))
                best = np.where(there[:, t, None], through.max(axis=1) + score[:, t], best)
            label = np.zeros(there.shape, int)
            label[:, -1] = best.argmax(axis=1)
            for t in range(there.shape[1] - 1, 0, -1):
                label[:, t - 1] = came[np.arange(len(own)), t, label[:, t]]
            for row, i in enumerate(own):
                out[i] = label[row, : len(pages[i])]
        return out


@lru_cache(1)
def trained() -> ChainField:
    return ChainField().train(labelled_pages())


def main_texts(model: ChainField, pages: list[str | None]) -> list[str]:
    parsed = [blocks(p, model.features) if p else [] for p in pages]
    return ["\n".join(b.text for b, y in zip(page, labels) if y) for page, labels in zip(parsed, model.decode(parsed))]


def extract(pages: DataFrame, html: str = "html", text: str = "text", chars: str = "n_chars", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with the main text and its code points."""
    model = trained()

    def run(column: pa.Array) -> list[pa.Array]:
        texts = []
        for i in range(0, len(column), 256):
            texts += main_texts(model, column.slice(i, 256).to_pylist())
        return [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]

    fields = [T.StructField(text, T.StringType()), T.StructField(chars, T.LongType())]
    return append_columns(pages, html, fields, run, keep)


def report(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"), keep=["page_id", "url"])

"""Main text of HTML pages: a tree-structured graphical model over DOM nodes.

Each block element and each run of text is content or not. A node's features (tag,
words of its class and id, length, share of links) give it a potential, and each
pair of parent and child one by the child's tag. Sum-product messages pass up and
down the tree, exactly, for all pages of a batch at once, depth by depth. Runs of
text with a marginal above one half are the main text.

Weights are trained by gradient ascent of the labels' likelihood, on pages labelled
by hand and on a bounded sample of pages whose markup tells the article. In half of
the sample the telling tag is hidden, so pages without it are learnt too.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.dom import Tree, attributes, parse
from tellerbook.llm.labelled_pages import PAGES
from tellerbook.llm.store import need_columns

FEATURES = 1 << 12
PAIRS = 64
#: Pages fetched for training at most, and characters of a page used in training.
SAMPLE, LONGEST = 300, 100_000
#: Tags that tell an article where a page has just one of them.
TELLING = ("article", "main")


def _slot(text: str, size: int) -> int:
    return zlib.crc32(text.encode()) % size


@lru_cache(maxsize=1 << 16)
def _element(tag: str, raw: str) -> tuple[int, ...]:
    own = attributes(raw) if raw else {}
    named = " ".join(own.get(k, "") for k in ("class", "id", "role", "itemprop"))
    words = {w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", named)}
    return tuple(_slot(x, FEATURES) for x in ("element", f"tag {tag}", *sorted(f"word {w}" for w in words)))


@lru_cache(maxsize=1 << 14)
def _leaf(parent: str, size: int, share: int, end: bool, signs: bool) -> tuple[int, ...]:
    names = ("text", f"in {parent}", f"size {size}", f"links {share}", f"end {end}", f"signs {signs}", f"in {parent} {end}")
    return tuple(_slot(x, FEATURES) for x in names)


@dataclass
class Forest:
    """The nodes of many pages, a page after the other."""

    parents: np.ndarray
    depths: np.ndarray
    pairs: np.ndarray
    features: np.ndarray
    starts: np.ndarray
    leaves: np.ndarray
    texts: list[str]
    pages: np.ndarray

    @classmethod
    def of(cls, trees: Iterable[Tree], hidden: Iterable[str] = ()) -> Forest:
        hidden = frozenset(hidden)
        parents, depths, pairs, cells, starts, leaves, texts, pages = [], [], [], [], [], [], [], []
        for page, tree in enumerate(trees):
            base = len(parents)
            for i, (up, tag, raw, text, linked) in enumerate(
                zip(tree.parents, tree.tags, tree.attributes, tree.texts, tree.linked, strict=True)
            ):
                starts.append(len(cells))
                parents.append(base + up if up >= 0 else -1)
                depths.append(depths[base + up] + 1 if up >= 0 else 0)
                shown = "div" if tag in hidden else tag
                pairs.append(_slot(shown, PAIRS))
                if text is None:
                    cells.extend(_element(shown, raw))
                else:
                    leaves.append(base + i)
                    texts.append(text)
                    pages.append(page)
                    above = tree.tags[up]
                    share = min(4, int(4 * linked / len(text) + 0.5))
                    signs = any(c in text for c in "©|»·")
                    size = len(text).bit_length()
                    cells.extend(_leaf("div" if above in hidden else above, size, share, text[-1] in ".!?…:\"'”", signs))
        arrays = (np.array(x, np.int64) for x in (parents, depths, pairs, cells, starts, leaves))
        return cls(*arrays, texts, np.array(pages, np.int64))

    def levels(self) -> list[np.ndarray]:
        order = np.argsort(self.depths, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(self.depths[order])) + 1) if len(order) else []


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Model:
    weights: np.ndarray
    pairs: np.ndarray

    def beliefs(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the nodes, and of each node's pair with its parent (parent first)."""
        n = len(forest.parents)
        inside, up, down = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))
        inside[:, 1] = np.add.reduceat(self.weights[forest.features], forest.starts)
        both = np.zeros((n, 2, 2))
        levels = forest.levels()
        for nodes in levels[:0:-1]:
            up[nodes] = _logsum(self.pairs[forest.pairs[nodes]] + inside[nodes][:, None, :], axis=2)
            np.add.at(inside, forest.parents[nodes], up[nodes])
        for nodes in levels[1:]:
            above = forest.parents[nodes]
            outer = inside[above] + down[above] - up[nodes]
            table = self.pairs[forest.pairs[nodes]] + outer[:, :, None]
            down[nodes] = _logsum(table, axis=1)
            both[nodes] = table + inside[nodes][:, None, :]
        total = inside + down
        chance = np.exp(total - _logsum(total, 1)[:, None])
        joint = np.exp(both - _logsum(both.reshape(n, 4), 1)[:, None, None])
        return chance, joint


def train(forest: Forest, labels: np.ndarray, steps: int = 150, rate: float = 0.15) -> Model:
    """Weights under which the labels of all nodes are likely, by Adam with a small penalty."""
    model = Model(np.zeros(FEATURES), np.zeros((PAIRS, 2, 2)))
    n = len(labels)
    of = np.repeat(np.arange(n), np.diff(np.append(forest.starts, len(forest.features))))
    child = np.flatnonzero(forest.parents >= 0)
    cell = forest.pairs[child] * 4 + labels[forest.parents[child]] * 2 + labels[child]
    seen = np.bincount(cell, minlength=PAIRS * 4).reshape(PAIRS, 2, 2)
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (model.weights, model.pairs)]
    for step in range(1, steps + 1):
        chance, joint = model.beliefs(forest)
        slope = np.bincount(forest.features, (labels - chance[:, 1])[of], FEATURES) / n - 1e-4 * model.weights
        expected = np.zeros((PAIRS, 2, 2))
        np.add.at(expected, forest.pairs[child], joint[child])
        for weight, (m, v), g in zip(
            (model.weights, model.pairs), moments, (slope, (seen - expected) / n - 1e-4 * model.pairs), strict=True
        ):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weight += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def _labels(tree: Tree, mark) -> list[int]:
    found = []
    for i, up in enumerate(tree.parents):
        own = mark(tree.tags[i], tree.attributes[i])
        found.append(own if own is not None else found[up] if up >= 0 else 0)
    return found


def _hand_mark(tag: str, raw: str) -> int | None:
    return 1 if "data-content" in raw else 0 if "data-other" in raw else None


def _telling(tree: Tree) -> str | None:
    return next((t for t in TELLING if tree.tags.count(t) == 1), None)


def fit(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labelled pages and at most ``sample`` pages with a telling tag.

    The sample is the first by a hash of the page's id; pages above ``LONGEST``
    characters are not used in training.
    """
    rows = need_columns(pages, "page_id", "html").where(F.length("html") <= LONGEST)
    rows = rows.where(F.lower("html").rlike("<(article|main)[ >]"))
    chosen = rows.orderBy(F.xxhash64("page_id", "html")).limit(sample)
    trees, labels, hidden = [], [], []
    for page in PAGES:
        tree = parse(page)
        trees.append(tree)
        labels.append(_labels(tree, _hand_mark))
        hidden.append(False)
    for i, row in enumerate(chosen.select("html").toLocalIterator()):
        tree = parse(row["html"])
        tag = _telling(tree)
        if tag:
            trees.append(tree)
            labels.append(_labels(tree, lambda t, _, tag=tag: 1 if t == tag else 0 if t == "aside" else None))
            hidden.append(i % 2 == 1)
    # Pages by hand are few: they count as much as the sample.
    weight = max(1, len(trees) // (2 * len(PAGES)))
    order = [*range(len(PAGES))] * weight + [*range(len(PAGES), len(trees))]
    plain = [i for i in order if not hidden[i]]
    masked = [i for i in order if hidden[i]]
    parts = [Forest.of(trees[i] for i in plain)]
    if masked:
        parts.append(Forest.of((trees[i] for i in masked), hidden=TELLING))
    marks = np.array([x for i in [*plain, *masked] for x in labels[i]], np.int64)
    return train(_joined(parts), marks)


def _joined(parts: list[Forest]) -> Forest:
    if len(parts) == 1:
        return parts[0]
    a, b = parts
    nodes, cells = len(a.parents), len(a.features)
    return Forest(
        np.concatenate([a.parents, np.where(b.parents >= 0, b.parents + nodes, -1)]),
        np.concatenate([a.depths, b.depths]),
        np.concatenate([a.pairs, b.pairs]),
        np.concatenate([a.features, b.features]),
        np.concatenate([a.starts, b.starts + cells]),
        np.concatenate([a.leaves, b.leaves + nodes]),
        a.texts + b.texts,
        np.concatenate([a.pages, b.pages + (a.pages.max(initial=-1) + 1)]),
    )


def main_texts(pages: list[str | None], model: Model) -> list[str]:
    """The main text of each page: its content blocks in page order, one a line."""
    out: list[list[str]] = [[] for _ in pages]
    forest = Forest.of(parse(p or "") for p in pages)
    if len(forest.leaves):
        chance, _ = model.beliefs(forest)
        for i in np.flatnonzero(chance[forest.leaves, 1] > 0.5):
            out[forest.pages[i]].append(forest.texts[i])
    return ["\n".join(blocks) for blocks in out]


def _extracted(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 64):
                part = batch.slice(a, 64)
                found = main_texts(part.column(2).to_pylist(), model)
                yield pa.RecordBatch.from_pydict(
                    {
                        "page_id": part.column(0),
                        "url": part.column(1),
                        "text": pa.array(found, pa.string()),
                        "n_chars": np.array([len(t) for t in found], np.int64),
                    }
                )

    return run


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page's main text.

    Character references are decoded, white space inside a block is one space, and
    blocks are joined by line feeds. A null or empty page gives an empty text; one of any
    length is parsed whole, in time that grows with its length. Repeated rows come out as often; further columns play no part; an empty table
    stays empty. Without ``model`` one is fitted.
    """
    model = model or fit(pages)
    rows = need_columns(pages, "page_id", "url", "html")
    kinds = "page_id long, url string, text string, n_chars long"
    return rows.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_extracted(model), kinds)

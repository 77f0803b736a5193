"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is lower-cased and has a vector of its own and one for each run of three
to five characters of it, its two ends marked; all are hashed into ``BUCKETS``
rows of one table. A bag holds the vectors of ``WINDOW`` words in a row; they are
averaged, and a softmax over two classes reads the average. Bags begin every
``STRIDE`` words, and a text is as toxic as its worst one: averages over
whole texts would dilute a few words in a long text (README has the figures).
Table and softmax are trained together by Adam over a bounded sample of labelled
texts, at first on all bags and then on the worst one of each text; a part put aside
then sets scale and offset of the logits (Platt's method). Misspelt
words share most runs with the words they come from, and a word's neighbours can
outweigh it.

For scoring, the table is multiplied by the softmax's weights once, so each
bucket has one number and a bag's logit is an average of such numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from tellerbook.llm.store import need_columns
from tellerbook.llm.words import mix

BUCKETS = 1 << 17
WIDTH = 4
RUNS = (3, 4, 5)
#: Words of a bag, and words from the beginning of one bag to the next.
WINDOW, STRIDE = 8, 4
#: The softmax sees averages enlarged, which speeds up training.
GAIN = 120.0
#: By so much a step of rate 1 shrinks the table: what only a few texts speak for fades.
DECAY = 1.0
#: Of each class every so manieth text is put aside, to calibrate the scores.
ASIDE = 5
#: The classifier is fitted on at most so many labelled texts of each class.
SAMPLE = {0: 2000, 1: 800}
#: Characters handled at once, and vectors gathered at once.
_CHUNK = 1 << 18
_PART = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, _CHUNK + (1 << 17)), base, np.uint64)
            steps[0] = 1
            _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS


def _slices(texts: list[str | None]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        t = t or ""
        if held and size + len(t) > _CHUNK:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


class Text:
    """Words of a few texts and the buckets of their runs of characters."""

    def __init__(self, texts: list[str]):
        # A space before, between and after the texts marks the ends of words.
        lowered = [t.lower() for t in texts]
        joined = " " + " ".join(lowered) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        space = (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))
        codes = np.where(space, np.uint32(0x20), codes)
        up, down = _powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=self.sums[1:])
        self.down = down
        self.starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
        self.ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
        ends = np.cumsum([len(t) + 1 for t in lowered])
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], ends]))
        self.words = self._hash(self.starts, self.ends)

    def _hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def word_buckets(self) -> np.ndarray:
        return ((self.words ^ np.uint64(0xA5A5)) % np.uint64(BUCKETS)).astype(np.int64)

    def run_buckets(self, n: int) -> np.ndarray:
        """The bucket of the run of n characters that starts at each place."""
        at = np.arange(len(self.sums) - n)
        return (self._hash(at, at + n) % np.uint64(BUCKETS)).astype(np.int64)

    def run_counts(self, n: int) -> np.ndarray:
        """How many runs of n characters each word has, its two end marks included."""
        return np.maximum(0, self.ends - self.starts + 3 - n)


def bags_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end and text of each bag, for texts whose words lie between the bounds.

    The last bag of a text ends with it; a text without words has none.
    """
    first, sizes = bounds[:-1], np.diff(bounds)
    counts = np.where(sizes > 0, 1 + -(-np.maximum(0, sizes - WINDOW) // STRIDE), 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    last = np.maximum(first, bounds[1:] - WINDOW)
    starts = np.minimum(first[owner] + STRIDE * step, last[owner])
    return starts, np.minimum(starts + WINDOW, bounds[1:][owner]), owner


@dataclass
class Model:
    """One number for each bucket, and the softmax's bias."""

    buckets: np.ndarray
    bias: float

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The logit of each text's worst bag, not a number without words."""
        out = []
        for part in _slices(texts):
            own = Text(part)
            total, n = self.buckets[own.word_buckets()].astype(np.float64), np.ones(len(own.words))
            for k in RUNS:
                sums = np.concatenate([[0.0], np.cumsum(self.buckets[own.run_buckets(k)], dtype=np.float64)])
                count = own.run_counts(k)
                some = count > 0
                first = own.starts[some] - 1
                total[some] += sums[first + count[some]] - sums[first]
                n += count
            starts, ends, owner = bags_of(own.bounds)
            worst = np.full(len(part), np.nan)
            if len(owner):
                sums, counts = (np.concatenate([[0.0], np.cumsum(x)]) for x in (total, n))
                averages = (sums[ends] - sums[starts]) / (counts[ends] - counts[starts])
                some, at = np.unique(owner, return_index=True)
                worst[some] = np.maximum.reduceat(averages, at)
            out.append(worst)
        return self.bias + GAIN * (np.concatenate(out) if out else np.zeros(0))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logits = self.logits(texts)
        chance = 1 / (1 + np.exp(-np.clip(logits, -40, 40)))
        return np.round(np.where(np.isnan(chance), 0.0, chance), 6)


def _sums(rows: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``rows[at]`` from each start to the next, a bounded part at a time."""
    out = np.empty((len(starts), rows.shape[1]), rows.dtype)
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(at), _PART)))
    for a, b in zip(cuts, [*cuts[1:], len(starts)], strict=True):
        if a < b:
            end = starts[b] if b < len(starts) else len(at)
            np.add.reduceat(rows[at[starts[a] : end]], starts[a:b] - starts[a], axis=0, out=out[a:b])
    return out


class _Bags:
    """The runs of each distinct word, the words of all texts in a row, and the bags of these."""

    def __init__(self, texts: list[str | None]):
        known: dict[int, int] = {}
        cells, lengths, words, sizes = [], [], [], [0]
        for part in _slices(texts):
            own = Text(part)
            runs = {k: own.run_buckets(k) for k in RUNS}
            whole, counts = own.word_buckets(), {k: own.run_counts(k) for k in RUNS}
            kinds, where, back = np.unique(own.words, return_index=True, return_inverse=True)
            ids = np.empty(len(kinds), np.int32)
            for i, (h, w) in enumerate(zip(kinds.tolist(), where.tolist(), strict=True)):
                ids[i] = known.setdefault(h, len(known))
                if ids[i] == len(lengths):
                    s = own.starts[w] - 1
                    mine = np.concatenate([whole[w : w + 1], *(runs[k][s : s + counts[k][w]] for k in RUNS)])
                    lengths.append(len(mine))
                    cells.append(mine.astype(np.int32))
            words.append(ids[back])
            sizes += np.diff(own.bounds).tolist()
        self.count = len(lengths)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        cells = np.concatenate(cells)
        self.used = np.flatnonzero(np.bincount(cells, minlength=BUCKETS))
        place = np.zeros(BUCKETS, np.int32)
        place[self.used] = np.arange(len(self.used), dtype=np.int32)
        self.cell = place[cells]
        del cells
        order = np.argsort(self.cell, kind="stable")
        self.cell_starts = np.searchsorted(self.cell, np.arange(len(self.used)), sorter=order)
        self.word_of = np.repeat(np.arange(self.count, dtype=np.int32), self.lengths)[order]
        #: The words of all texts in a row, and the bags among them.
        self.words = np.concatenate(words)
        self.first, self.end, self.owner = bags_of(np.cumsum(sizes))
        runs_up_to = np.concatenate([[0], np.cumsum(self.lengths[self.words])])
        self.sizes = (runs_up_to[self.end] - runs_up_to[self.first]).astype(np.float32)
        self.owner_starts = np.flatnonzero(np.append(True, np.diff(self.owner) > 0))

    def averages(self, table: np.ndarray) -> np.ndarray:
        """Of each bag the average of its vectors."""
        sums = _sums(table, self.cell, self.starts)[self.words]
        up_to = np.concatenate([np.zeros((1, table.shape[1])), np.cumsum(sums, axis=0, dtype=np.float64)])
        return ((up_to[self.end] - up_to[self.first]) / self.sizes[:, None]).astype(np.float32)

    def slopes(self, back: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """How the loss changes with the table, from how it changes with these bags' averages."""
        back = back / self.sizes[bags, None]
        edges = np.zeros((len(self.words) + 1, back.shape[1]))
        np.add.at(edges, self.first[bags], back)
        np.add.at(edges, self.end[bags], -back)
        held = np.cumsum(edges[:-1], axis=0)
        each = [np.bincount(self.words, held[:, k], self.count) for k in range(back.shape[1])]
        return _sums(np.stack(each, axis=1).astype(np.float32), self.word_of, self.cell_starts)

    def worst(self, logits: np.ndarray) -> np.ndarray:
        """Of each text with words, the bag with the highest logit, the first of equal ones."""
        most = np.maximum.reduceat(logits, self.owner_starts)
        sizes = np.diff(np.append(self.owner_starts, len(logits)))
        at = np.flatnonzero(logits == np.repeat(most, sizes))
        return at[np.append(True, np.diff(self.owner[at]) > 0)]


def scale_and_offset(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """The logistic curve over logits that fits labels best, none of them held for certain."""
    ones, zeros = (labels == 1).sum(), (labels == 0).sum()
    wanted = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    at = np.array([1.0, 0.0])
    columns = np.stack([logits, np.ones(len(logits))], axis=1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(columns @ at, -40, 40)))
        bend = columns.T @ (columns * (chance * (1 - chance))[:, None]) + 1e-6 * np.eye(2)
        at = at - np.linalg.solve(bend, columns.T @ (chance - wanted))
    return float(at[0]), float(at[1])


def train(texts: list[str | None], labels: list[int], steps: int = 60, rate: float = 0.05, seed: int = 5) -> Model:
    """Fit and calibrate; without both labels, a constant score.

    Too few texts to put some of both classes aside are all fitted, and not calibrated.
    """
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max() or not any((t or "").split() for t in texts):
        bias = 0.0 if not len(y) else float(np.clip(np.log((y.mean() + 1e-3) / (1.001 - y.mean())), -5, 5))
        return Model(np.zeros(BUCKETS, np.float32), bias)
    place = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y == 0))
    aside = place % ASIDE == 0
    few = min((aside & (y == c)).sum() for c in (0, 1)) < 2 or not any((t or "").split() for t, a in zip(texts, aside, strict=True) if not a)
    if few:
        return _fitted(texts, y, steps, rate, seed)
    model = _fitted([t for t, a in zip(texts, aside, strict=True) if not a], y[~aside], steps, rate, seed)
    logits = model.logits([t for t, a in zip(texts, aside, strict=True) if a])
    told = ~np.isnan(logits)
    if len(set(y[aside][told])) < 2:
        return model
    scale, offset = scale_and_offset(logits[told], y[aside][told])
    if scale <= 0:
        return model
    return Model((model.buckets * scale).astype(np.float32), scale * model.bias + offset)


def _fitted(texts: list[str | None], y: np.ndarray, steps: int, rate: float, seed: int) -> Model:
    """Table and softmax, trained together."""
    bags = _Bags(texts)
    random = np.random.default_rng(seed)
    weights = {
        "table": random.normal(0, 0.05, (len(bags.used), WIDTH)).astype(np.float32),
        "softmax": random.normal(0, 0.5, (WIDTH, 2)).astype(np.float32),
        "bias": np.zeros(2, np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    marks = y[bags.owner].astype(np.int64)
    even = (1 / np.bincount(bags.owner)[bags.owner]).astype(np.float32)
    every = np.arange(len(bags.owner))
    for step in range(1, steps + 1):
        seen = bags.averages(weights["table"]) * GAIN
        logits = seen @ weights["softmax"] + weights["bias"]
        if step <= steps // 6:
            chosen, share = every, even
        else:
            chosen = bags.worst(logits[:, 1] - logits[:, 0])
            share = np.ones(len(chosen), np.float32)
        logits, seen = logits[chosen], seen[chosen]
        error = np.exp(logits - logits.max(axis=1, keepdims=True))
        error /= error.sum(axis=1, keepdims=True)
        error[np.arange(len(chosen)), marks[chosen]] -= 1
        error *= share[:, None] / len(y)
        slopes = {
            "table": bags.slopes(error @ weights["softmax"].T * GAIN, chosen),
            "softmax": seen.T @ error + 1e-5 * weights["softmax"],
            "bias": error.sum(axis=0),
        }
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, slope in slopes.items():
            m, v = moments[k]
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            weights[k] -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights["table"] *= 1 - pace * DECAY
    apart = weights["softmax"][:, 1] - weights["softmax"][:, 0]
    buckets = np.zeros(BUCKETS, np.float32)
    buckets[bags.used] = weights["table"] @ apart
    return Model(buckets, float(weights["bias"][1] - weights["bias"][0]))


def fit(documents: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Model:
    """A model from labelled documents that are not held out.

    At most ``sample`` texts of each class, the first by a hash of their ids, are
    fetched; that bounds the driver's memory. Rows with a null label or text do
    not count; repeated rows of a document count once. Texts are read whole.
    """
    own = need_columns(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    own = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = need_columns(documents, "doc_id", "text").where("text IS NOT NULL")
    texts, marks = [], []
    for label, most in (sample or SAMPLE).items():
        chosen = own.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        got = rows.join(chosen, "doc_id").dropDuplicates(["doc_id", "text"])
        got = got.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(most).toArrow()
        texts += got.column("text").to_pylist()
        marks += [label] * got.num_rows
    return train(texts, marks)


def held_out(doc_id: str):
    """Documents whose labels are never learnt from; a null id counts as such."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def score(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 from ``threshold``) to every row.

    The whole text is read, at any length. A null or empty text or one without
    words has score 0; repeated rows get equal scores. All columns of ``documents`` stay, but for earlier ones named
    score or predicted; an empty table stays empty.
    """
    rows = documents.drop("score", "predicted")
    place = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(batch.column(place).to_pylist())
            columns = [*batch.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "predicted"])

    kinds = StructType([*rows.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return rows.mapInArrow(run, kinds)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(documents, labels)
    rows = need_columns(documents, "doc_id", "text")
    return score(rows, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")

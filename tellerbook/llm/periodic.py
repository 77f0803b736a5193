"""Periodic runs of words, found by online dynamic programming over sparse diagonals.

The pairs (word, earlier equal word) lie on diagonals, one for each lag. Words are
read in order; the earlier occurrences of a word lengthen the matches of their lags,
and a diagonal that the next word does not lengthen has ended and is emitted if it is
long enough.

A run of period q has at least 3 q words, so behind its first 2 q words each word
agrees with the one q before it on as many preceding words as well. An earlier
occurrence is therefore visited only with its context: for periods in (w / 2, w] the
nearest earlier occurrence of the word together with the w - 1 words before it.
Inside a run of smallest period q that is exactly the word q before: another one,
nearer by d, would give the run a period that divides q. So one visit per word and
doubling of the window is enough for every run, whatever its period, and a text
without repeated windows of ``LEAST_WINDOW`` words needs no visit at all. Windows are
numbered by doubling (a window is a pair of halves), not hashed. Time grows
with n log n, also for one word a million times.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.store import need_columns
from tellerbook.llm.words import chunks

#: A run has at least so many words, and at least so many periods.
LEAST, PERIODS = 24, 3
#: Windows of the smallest periods; LEAST allows periods up to it a whole window.
LEAST_WINDOW = LEAST // PERIODS

_RUN = "struct<start:long,length:long,period:long>"
SCHEMA = f"doc_id long, n_words long, runs array<{_RUN}>, strongest {_RUN}, collapsed string"

Run = tuple[int, int, int]


def _numbered(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].reshape(-1).astype(np.int64)


def _nearest_earlier(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose code occurred before, and how far back the last time was."""
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    return order[1:][same], (order[1:] - order[:-1])[same]


def visits(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse matches in the order of words: word, lag, and words matched up to it."""
    found = []
    codes, width, lowest = words, 1, 0
    while len(words) >= max(LEAST, PERIODS * (lowest + 1)):
        while width < LEAST_WINDOW or width <= lowest:
            codes = _numbered(codes[:-width] * (len(words) + 1) + codes[width:])
            width *= 2
        at, lag = _nearest_earlier(codes)
        if not len(at):
            break
        near = (lag > lowest) & (lag <= width)
        found.append((at[near] + width - 1, lag[near], np.full(near.sum(), width)))
        lowest = width
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    at, lag, matched = (np.concatenate(part) for part in zip(*found, strict=True))
    order = np.lexsort((lag, at))
    return at[order], lag[order], matched[order]


def online_runs(words: np.ndarray) -> Iterator[Run]:
    """(start, length, period) of each run, as soon as its diagonal has ended."""
    active: dict[int, tuple[int, int]] = {}

    def ended(before: int) -> Iterator[Run]:
        for lag, (last, matched) in list(active.items()):
            if last < before:
                del active[lag]
                if matched + lag >= max(LEAST, PERIODS * lag):
                    yield last + 1 - matched - lag, matched + lag, lag

    for word, lag, window in zip(*(part.tolist() for part in visits(words)), strict=True):
        yield from ended(word - 1)
        matched = active[lag][1] + 1 if lag in active else window
        active[lag] = (word, matched)
    yield from ended(len(words))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run contains behind its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()
    return b" ".join([words[i] for i in kept])


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest exponent; ties go to the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def text_runs(text: bytes) -> tuple[list[bytes], list[Run]]:
    """The words of a text and its runs by start, then period."""
    words = text.split()  # at the bytes 0x20 and 0x09 to 0x0D
    if len(words) < LEAST:
        return words, []
    numbers: dict[bytes, int] = {}
    own = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    return words, sorted(online_runs(own), key=lambda r: (r[0], r[2]))


def _named(run: Run | None) -> dict | None:
    return run and dict(zip(("start", "length", "period"), run, strict=True))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, part in chunks(batch.column(1)):
            ids = batch.column(0).slice(at, len(part))
            found = [text_runs(text or b"") for text in part.to_pylist()]
            whole = pa.array([collapsed(*f) for f in found], pa.binary())
            run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids,
                    "n_words": pa.array([len(words) for words, _ in found], pa.int64()),
                    "runs": pa.array([[_named(r) for r in runs] for _, runs in found], pa.list_(run)),
                    "strongest": pa.array([_named(strongest(runs)) for _, runs in found], run),
                    # Spark may hold texts that are not UTF-8; they pass as they are.
                    "collapsed": pc.cast(whole, options=pc.CastOptions(pa.string(), allow_invalid_utf8=True)),
                }
            )


def periodic_runs(documents: DataFrame) -> DataFrame:
    """The runs of every document and its text with each run cut to its first period.

    A run is a stretch of words of smallest period q, at least max(24, 3 q) words
    long, which no neighbouring word extends. Returns doc_id, n_words, runs (start,
    length and period, by start, then period), strongest (greatest length / period) and
    collapsed, the kept words joined by single spaces.

    Null, empty and blank texts have no words, no runs, a null strongest and an empty
    collapsed text. Texts are taken whole, whatever their length. Null and repeated ids
    are rows like any other; further columns play no part; an empty table stays empty.
    Each row is its task's own work: nothing is shuffled.
    """
    rows = need_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_find, SCHEMA)

"""Token counts without tokens: Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character;
dynamic programming carries the best score up to there and its number of pieces.
Ties and unknown characters go as in the tokenizers' unigram models: of equal
scores the path whose last piece begins first stays; a character that is no piece
costs ten less than the lowest score and counts its UTF-8 bytes (byte fallback).

Spaces become the mark U+2581, one is put before the text, and no piece has the mark
behind another character. So every path passes through the ends of words, words can
be counted one by one, and each task remembers those it has met.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.store import need_columns

MARK = "▁"
#: Words that a Python worker remembers; it then starts afresh.
REMEMBERED = 400_000
#: Longer words are counted anew each time.
LONGEST = 64


def default_vocabulary() -> list[tuple[str, float]]:
    """The pieces of the public 32k vocabulary, scored -ln(rank).

    No public unigram scores are at hand; by Zipf's law the k-th commonest piece has
    a probability in proportion to 1/k. Byte and control pieces are not matched.
    """
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [
        (model.get_score(i), i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    plain.sort(key=lambda x: (-x[0], x[1]))
    return [(model.id_to_piece(i), -math.log(k)) for k, (_, i) in enumerate(plain, start=1)]


class Unigram:
    """Counts the pieces of the best segmentation."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.single: dict[str, bool] = {}
        lowest = 0.0
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
            lowest = min(lowest, score)
            if len(piece) == 1:
                self.single[piece] = True
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"a mark inside a piece: {piece!r}")
        self.automaton.make_automaton()
        self.unknown = lowest - 10.0
        self.words: dict[str, tuple[int, float]] = {}

    def segment(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path; text is already marked."""
        n = len(text)
        best, count = [-math.inf] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        done = 0
        single, unknown = self.single, self.unknown

        def step(end: int) -> None:
            # An unknown character is the shortest candidate, so it comes last.
            c = text[end - 1]
            if c not in single and best[end - 1] + unknown > best[end]:
                best[end] = best[end - 1] + unknown
                count[end] = count[end - 1] + len(c.encode("utf-8", "surrogatepass"))

        for last, (length, score) in self.automaton.iter(text):
            end = last + 1
            while done < end - 1:
                done += 1
                step(done)
            start = end - length
            found = best[start] + score
            if found > best[end]:
                best[end] = found
                count[end] = count[start] + 1
        while done < n:
            done += 1
            step(done)
        return count[n], best[n]

    def word(self, text: str) -> tuple[int, float]:
        known = self.words.get(text)
        if known is None:
            known = self.segment(text)
            if len(text) <= LONGEST:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[text] = known
        return known

    def count(self, text: str | None) -> tuple[int, float]:
        """Pieces and score of a whole text; none for a null or empty one."""
        if not text:
            return 0, 0.0
        marked = (MARK + text.replace(" ", MARK)).split(MARK)
        known, word = self.words.get, self.word
        pieces, total, marks = 0, 0.0, 0
        for part in marked[1:]:
            marks += 1
            if part:
                key = MARK * marks + part
                found = known(key) or word(key)
                pieces += found[0]
                total += found[1]
                marks = 0
        if marks:
            found = word(MARK * marks)
            pieces, total = pieces + found[0], total + found[1]
        return pieces, total


@lru_cache(maxsize=1)
def _default() -> Unigram:
    return Unigram(default_vocabulary())


def _counted(vocabulary: list[tuple[str, float]] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _default() if vocabulary is None else Unigram(vocabulary)
        for batch in batches:
            found = [model.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column(0),
                    "n_tokens": np.array([n for n, _ in found], np.int64),
                    "score": np.array([s for _, s in found], np.float64),
                }
            )

    return run


def token_counts(documents: DataFrame, vocabulary: list[tuple[str, float]] | None = None) -> DataFrame:
    """doc_id, n_tokens and score (the best path's) of every document.

    Whole texts of any length are counted; a null or empty text has 0 tokens. Repeated
    rows come out as often, further columns play no part, an empty table stays empty.
    ``vocabulary`` lists pieces and scores, without byte and control pieces.
    """
    rows = need_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_counted(vocabulary), "doc_id long, n_tokens long, score double")

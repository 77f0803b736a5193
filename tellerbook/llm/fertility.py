"""Quality rules: repeated lines and windows, and tokeniser fertility in bands per language.

A public vocabulary measures each text: characters per token, the share of tokens
that are raw bytes (white space apart), and the entropy of the tokens, as a share of
the highest possible for so many tokens. Bands come from the quartiles over all
distinct texts that pass the base rules, by language and by length (each doubling of
the number of tokens is a class of its own, as short texts vary more and entropy
depends on length). A class of fewer than ``ENOUGH`` texts takes the band of itself and
its neighbours of half and twice the length, or else of its language, its script, or all
texts: the first of these with enough. A document outside a band is rejected. Exact copies count as one
text, near copies as a few: a text stands for those of its class with which it shares
one of ``ORDERS`` least hashes of its windows, one order after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.store import need_columns, stored
from tellerbook.llm.words import chunks, mix, windows, word_hashes

WINDOW = 5
#: A band's ends lie WIDTH times as far from the median as the quartile on that side.
QUANTILES, WIDTH = (0.25, 0.5, 0.75), 6.0
MEASURES = ("chars_per_token", "byte_share", "entropy")
#: Distinct texts that a band needs; the band of all texts serves with fewer.
ENOUGH = 30
#: Up to so many classes (languages x scripts x doublings) bands are sent to all tasks, beyond it they are joined.
FEW_CLASSES = 20_000
#: Least distance of a band's ends from its median, where a language hardly varies.
LEAST = {"chars_per_token": 0.2, "byte_share": 0.02, "entropy": 0.04}
#: First letters of blocks of scripts (fixed values).
SCRIPTS = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Indic"), (0x0E00, "Thai"), (0x0F00, "other"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"),
)
#: Orders of the windows, by whose least ones near copies are found (fixed values).
ORDERS = mix(np.arange(2001, 2005, dtype=np.uint64))
_FIRST = np.array([a for a, _ in SCRIPTS], np.uint32)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
CLASS = ("lang", "script", "doubling")
KINDS = (
    "doc_id long, lang string, script string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, entropy double, "
    "least array<long>"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    found = sentencepiece.SentencePieceProcessor(model_file=path)
    size = found.get_piece_size()
    raw = np.array([found.is_byte(i) for i in range(size)])
    for i in np.flatnonzero(raw):
        if int(found.id_to_piece(int(i))[3:5], 16) in range(0x09, 0x0E):
            raw[i] = False
    return found, raw


def least(own: np.ndarray) -> list[int]:
    """The least of a text's windows in each order; those of near copies are mostly equal."""
    return [int(mix(own ^ order).min().view(np.int64)) for order in ORDERS] if len(own) else []


def repeated_words(own: np.ndarray) -> int:
    """Words inside windows of five that occur twice or more, the first ones included."""
    if not len(own):
        return 0
    _, back, counts = np.unique(own, return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[back] > 1)
    if not len(twice):
        return 0
    edge = np.zeros(len(own) + WINDOW, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return int((np.cumsum(edge) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


def script(text: str) -> str:
    """The commonest script among the letters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes[(codes >= 0x41) & ~((codes > 0x5A) & (codes < 0x61)) & ~((codes > 0x7A) & (codes < 0xC0))]
    if not len(codes):
        return "script: none"
    block = np.bincount(np.searchsorted(_FIRST, codes, side="right") - 1, minlength=len(SCRIPTS))
    totals: dict[str, int] = {}
    for (_, name), n in zip(SCRIPTS, block, strict=True):
        totals[name] = totals.get(name, 0) + int(n)
    return "script: " + max(totals, key=lambda k: (totals[k], k))


def _measured(ids: list[int], chars: int, raw: np.ndarray) -> tuple[int, float | None, float | None, float | None]:
    n = len(ids)
    if not n:
        return 0, None, None, None
    own = np.array(ids)
    counts = np.unique(own, return_counts=True)[1] / n
    highest = np.log2(min(n, len(raw)))
    entropy = float(-(counts * np.log2(counts)).sum() / highest) if highest else 1.0
    return n, chars / n, float(raw[own].mean()), entropy


def _measure(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, raw = _pieces(vocabulary or default_vocabulary())
        for batch in batches:
            for at, part in chunks(batch.column(1)):
                first, hashes, _, _, data = word_hashes(part, lower=False)
                n = len(part)
                texts = [t or b"" for t in part.to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
                start = (data & 0xC0) != 0x80
                chars, words, symbols = (
                    np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in (start, start & ~space, _SYMBOL[data])
                )
                whole = [t.decode("utf-8", "replace") for t in texts]
                tokens = [_measured(ids, int(c), raw) for ids, c in zip(pieces.encode(whole, num_threads=1), chars, strict=True)]
                langs = batch.column(2).slice(at, n).to_pylist()
                columns = list(zip(*tokens, strict=True))
                scripts = [script(t) for t in whole]
                owns = [windows(hashes[a:b], WINDOW) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(at, n),
                        "lang": [x or own for x, own in zip(langs, scripts, strict=True)],
                        "script": scripts,
                        "n_words": np.diff(first),
                        "word_chars": words,
                        "n_symbols": symbols,
                        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
                        "n_repeat_words": np.array([repeated_words(own) for own in owns], np.int64),
                        "n_tokens": np.array(columns[0], np.int64),
                        **{m: pa.array(c, pa.float64()) for m, c in zip(MEASURES, columns[1:], strict=True)},
                        "least": pa.array([least(own) for own in owns], pa.list_(pa.int64())),
                    }
                )

    return run


def _outside(measure: str) -> Column:
    """True where the measure leaves the band of its language and length."""
    low, middle, high = (F.col(f"{measure}_band")[i] for i in range(3))
    below = F.greatest((middle - low) * WIDTH, F.lit(LEAST[measure]))
    above = F.greatest((high - middle) * WIDTH, F.lit(LEAST[measure]))
    return (F.col(measure) < middle - below) | (F.col(measure) > middle + above)


def _distinct(measured: DataFrame) -> DataFrame:
    """One row of each group of copies in a class, by one order after the other.

    A near copy stays only if it has a least window of its own in every order. Each
    step is an aggregate by class and hash, so copies of a text meet in the tasks
    that hold them, before any exchange.
    """
    chosen = measured.where("NOT base_failed")
    for k in range(len(ORDERS)):
        own = F.struct(F.xxhash64("least", *MEASURES).alias("h"), "least", *MEASURES)
        chosen = chosen.groupBy(*CLASS, F.col("least")[k].alias("_least")).agg(F.min(own).alias("own"))
        chosen = chosen.select(*CLASS, "own.least", *[f"own.{m}" for m in MEASURES])
    return chosen


def _bands(measured: DataFrame) -> DataFrame:
    """The band of each class of documents: of the narrowest pool with enough texts.

    A text is in the pools of its class, of the classes beside it, its language, its
    script, and of all; pools are aggregated in the tasks before any exchange.
    """
    none, beside = F.lit(None).cast("string"), F.sequence(F.col("doubling") - 1, F.col("doubling") + 1)
    level = "struct<level:int,name:string,doubling:bigint>"
    pools = F.array(
        F.struct(F.lit(0), "lang", "doubling").cast(level),
        F.struct(F.lit(2), "lang", F.lit(-1)).cast(level),
        F.struct(F.lit(3), "script", F.lit(-1)).cast(level),
        F.struct(F.lit(4), none, F.lit(-1)).cast(level),
    )
    pools = F.concat(pools, F.transform(beside, lambda d: F.struct(F.lit(1), "lang", d).cast(level)))
    quartiles = [F.percentile_approx(m, list(QUANTILES), 10_000).alias(f"{m}_band") for m in MEASURES]
    found = _distinct(measured).select(F.explode(pools).alias("pool"), *MEASURES)
    found = found.groupBy("pool").agg(F.count("*").alias("n"), *quartiles).where((F.col("n") >= ENOUGH) | (F.col("pool.level") == 4))

    classes = measured.where("NOT base_failed").select(*CLASS).distinct()
    asked = F.array(
        F.struct(F.lit(0), "lang", "doubling").cast(level),
        F.struct(F.lit(1), "lang", "doubling").cast(level),
        F.struct(F.lit(2), "lang", F.lit(-1)).cast(level),
        F.struct(F.lit(3), "script", F.lit(-1)).cast(level),
        F.struct(F.lit(4), none, F.lit(-1)).cast(level),
    )
    asked = classes.select(*CLASS, F.explode(asked).alias("pool"))
    same = (F.col("a.pool.level") == F.col("b.pool.level")) & (F.col("a.pool.doubling") == F.col("b.pool.doubling"))
    same &= F.col("a.pool.name").eqNullSafe(F.col("b.pool.name"))
    names = [f"{m}_band" for m in MEASURES]
    held = asked.alias("a").join(found.alias("b"), same).select(*[f"a.{c}" for c in CLASS], "a.pool.level", *[f"b.{n}" for n in names])
    best = held.groupBy(*CLASS).agg(F.min(F.struct("level", *names)).alias("own"))
    return stored(best.select(*CLASS, *[f"own.{n}" for n in names]), "bands")


def quality_rules(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The base counts, tokeniser measures and the verdict on every document.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, the measures and ``outside``, the measure that decided. A null,
    empty or blank text has no words and fails the base rules; texts are measured whole,
    whatever their length. A null lang stands for the text's commonest script. Every
    document that passes the base rules is held against a band, also one that is alone
    in its language and length. Repeated rows are documents of their
    own, further columns play no part, an empty table stays empty.
    """
    rows = need_columns(documents, "doc_id", "text", "lang").select(F.col("doc_id").cast("long"), "text", "lang")
    measured = stored(rows.mapInArrow(_measure(vocabulary), KINDS), "fertility")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)
    measured = measured.withColumn("doubling", F.floor(F.log2(F.greatest(F.lit(1), F.col("n_tokens")))))
    bands = _bands(measured)
    if bands.count() <= FEW_CLASSES:
        bands = F.broadcast(bands)
    joined = measured.join(bands, list(CLASS), "left")
    outside = F.coalesce(*[F.when(_outside(m), F.lit(m)) for m in MEASURES])
    judged = joined.withColumn("outside", F.when(~F.col("base_failed"), outside))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.col("outside").isNull()).alias("kept"),
        "lang", "n_tokens", *MEASURES, "outside",
    )

"""Words of texts as 64-bit hashes, in numpy, a few megabytes at a time.

A word is a run of characters other than the six ASCII white-space characters
(0x20 and 0x09 to 0x0D). These are single bytes in UTF-8, so the rule can be
applied to the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The same rule as a pattern, for Java's and Python's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
_CHUNK = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, _CHUNK + (1 << 17))
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def chunks(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of at most a few megabytes (or one text), with their first index."""
    texts = texts.cast(pa.large_binary())
    lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1])
    first, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > _CHUNK:
            yield first, texts.slice(first, i - first)
            first, held = i, 0
        held += int(n)
    if first < len(texts):
        yield first, texts.slice(first)


def word_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slice from ``chunks``.

    Returns each text's first word index (one more entry than texts), the hash of
    each word, its first and end byte in the slice, and the slice's bytes. A null
    text has no words.
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return np.zeros(len(texts) + 1, np.int64), none.astype(np.uint64), none, none, raw
    space = _SPACE[raw]
    before, after = np.empty(len(raw), bool), np.empty(len(raw), bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    inner = bounds[(bounds > 0) & (bounds < len(raw))]
    before[inner], after[inner - 1] = True, True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    up, down = _powers(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[lower][raw] * up, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return np.searchsorted(starts, bounds), hashes, starts, ends, raw


_STEPS = mix(np.arange(1001, 1065, dtype=np.uint64)) | np.uint64(1)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` consecutive words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(m, np.uint64)
    for k in range(n):
        total += hashes[k : k + m] * _STEPS[k]
    return mix(total)


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """Each text's set of ``n``-word shingles as sorted 64-bit hashes.

    A text with fewer words has its whole sequence as the one shingle; a null
    text or one without words has none. A-Z count as a-z.
    """
    for _, part in chunks(texts):
        first, hashes, *_ = word_hashes(part, lower=True)
        for a, b in zip(first[:-1], first[1:], strict=True):
            own = hashes[a:b]
            if len(own) >= n:
                yield np.unique(windows(own, n))
            elif len(own):
                yield windows(own, len(own)) ^ np.uint64(len(own))
            else:
                yield own

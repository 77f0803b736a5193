"""Cost-balanced packing of tokenised documents into fixed-length sequences.

A document is its token ids and the end id 0. Whole multiples of the sequence
length fill sequences of their own. The rest of each document is packed within
lots of about ``LOT`` documents: the longest first, each to the sequence of the
lowest cost (linear plus quadratic in the length of each piece) that has room.
What has room nowhere is cut over the sequences with the most room, so a lot
wastes less than one sequence.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerbook.llm.groups import each_group
from tellerbook.llm.store import need_columns, stored

LENGTH = 1024
LOT = 512
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1 / 1024
#: The pattern that splits text before the merges of the rank file (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The added token of byte_bpe_50k.json and its id, which no rank file holds (fixed values).
ADDED, ADDED_ID = "<|endoftext|>", 50256
#: White space of PATTERN. The matcher keeps a state for each character of a run, a million at most.
SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
RUN = 100_000
_LONG = re.compile(f"(?<!{SPACE}){SPACE}{{{RUN},}}+")


@lru_cache(maxsize=2)
def encoder(ranks: str):
    """The byte-level BPE of a rank file, without added tokens."""
    import tiktoken

    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def default_ranks() -> str:
    """The rank file of byte_bpe_50k.json: the same vocabulary and ids, encoded five times as fast."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_ids(ranks: str, text: str) -> list[int]:
    """The ids of a text of any length.

    With the default rank file ADDED is one token, which parts the text around it, as
    in the vocabulary's tokenizer. PATTERN makes one piece of a run of white space, without its last character if
    text follows. Long runs are merged as that piece, apart from the matcher.
    """
    encode = encoder(ranks).encode_ordinary
    if ADDED in text and ranks == default_ranks():
        ids = []
        for part in text.split(ADDED):
            ids += [*token_ids(ranks, part), ADDED_ID]
        return ids[:-1]
    if len(text) < RUN:
        return encode(text)
    ids, at = [], 0
    for run in _LONG.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encode(text[at : run.start()])
        ids += encoder(ranks)._core_bpe.encode_single_piece(text[run.start() : end].encode())
        at = end
    return ids + encode(text[at:])


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def _encoded(ranks: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = ranks or default_ranks()
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                ids = [
                    np.asarray([*token_ids(path, t or ""), 0], dtype="<u4") for t in part.column(1).to_pylist()
                ]
                heads = [[checksum(x[s : s + LENGTH]) for s in range(0, len(x) - LENGTH + 1, LENGTH)] for x in ids]
                tails = [x[len(h) * LENGTH :].tobytes() for x, h in zip(ids, heads, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column(0),
                        "doc_tokens": np.array([len(x) for x in ids], np.int64),
                        "heads": pa.array(heads, pa.list_(pa.int64())),
                        "tail": pa.array(tails, pa.binary()),
                    }
                )

    return run


def place(lengths: list[int]) -> list[list[tuple[int, int, int]]]:
    """Pieces (sequence, offset, length) of each document, none of them above LENGTH.

    Documents go from the longest to the shortest, ties in the order given.
    """
    count = -(-sum(lengths) // LENGTH)
    cost, room = np.zeros(count), np.full(count, LENGTH)
    pieces: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        left = lengths[i]
        while left:
            fits = room >= left
            s = int(np.argmin(np.where(fits, cost, np.inf))) if fits.any() else int(np.argmax(room))
            n = min(left, int(room[s]))
            pieces[i].append((s, LENGTH - int(room[s]), n))
            cost[s] += LINEAR * n + QUADRATIC * n * n
            room[s] -= n
            left -= n
    return pieces


def _packed(rows: pa.Table) -> Iterator[dict]:
    ids, totals = rows.column("doc_id").to_pylist(), rows.column("doc_tokens").to_pylist()
    heads = rows.column("heads").to_pylist()
    tails = [np.frombuffer(t.as_buffer(), "<u4") for t in rows.column("tail")]
    lot = rows.column("lot")[0].as_py()
    placed = place([len(t) for t in tails])
    first = max((s for p in placed for s, _, _ in p), default=-1) + 1
    out = []
    for doc, total, own, tail, pieces in zip(ids, totals, heads, tails, placed, strict=True):
        for k, crc in enumerate(own):
            out.append((doc, k * LENGTH, LENGTH, crc, total, first, 0))
            first += 1
        at = 0
        for s, offset, n in pieces:
            out.append((doc, len(own) * LENGTH + at, n, checksum(tail[at : at + n]), total, s, offset))
            at += n
    doc, *columns = zip(*out, strict=True)
    names = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    found = {n: np.array(c, np.int64) for n, c in zip(names, columns, strict=True)}
    found["sequence_id"] += lot << 32
    yield {"doc_id": list(doc), **found}


def pack(documents: DataFrame, ranks: str | None = None) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset. A
    null or empty text is the end id alone; a very long one is cut into whole sequences
    and one rest. Repeated rows are documents of their own and null ids are allowed; an
    empty table gives no pieces. Documents of equal length are placed in the order of
    their ids. ``ranks`` is the
    path of a rank file at every executor; by default the one of byte_bpe_50k, whose
    added token <|endoftext|> is one token in texts too. Other rank files add none.
    Further columns play no part.

    Encoded documents are written once; a lot is drawn for each written row, so rows
    that are equal, however many, are spread over all lots.
    """
    rows = need_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    kinds = "doc_id long, doc_tokens long, heads array<long>, tail binary"
    ready = stored(rows.mapInArrow(_encoded(ranks), kinds), "encoded")
    lots = max(1, -(-ready.count() // LOT))
    # The number of a row of a written table, the same whenever a task reads it again.
    lot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(lots))
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return each_group(ready.withColumn("lot", lot), "lot", _packed, kinds, "doc_id", "doc_tokens")

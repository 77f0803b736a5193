import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tellerbook.llm import packing
from tellerbook.llm.packing import LENGTH, SPACE, default_ranks, encoder, pack, place, token_ids

from llm_helpers import ODD, documents, spoken


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_round_trip(spark, random, tokenizer):
    texts = [" ".join(spoken(random, int(random.integers(0, 900)))) for _ in range(120)] + ODD
    pieces = pack(documents(spark, texts, extra=True)).collect()
    of, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(of[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= LENGTH
    assert sum(p.length for p in pieces) > LENGTH * (len(sequences) - 1)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=200))
def test_ranks_give_the_tokenizers_ids(tokenizer, text):
    assert encoder(default_ranks()).encode_ordinary(text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, LENGTH - 1), max_size=60))
def test_places_hold_everything(lengths):
    room = defaultdict(int)
    for n, pieces in zip(lengths, place(lengths), strict=True):
        assert sum(x for _, _, x in pieces) == n
        for s, _, x in pieces:
            room[s] += x
    assert all(v <= LENGTH for v in room.values())
    assert len(room) <= -(-sum(lengths) // LENGTH)


def test_costs_are_balanced():
    """Short documents are spread over the sequences rather than piled up in one."""
    pieces = place([500] * 4 + [12] * 40)
    sequences = defaultdict(list)
    for own in pieces:
        for s, _, n in own:
            sequences[s].append(n)
    assert max(x.count(500) for x in sequences.values()) <= 2


def test_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "c")]
    found = pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((p.doc_id or -1, p.length) for p in found) == [(-1, 2), (1, 3), (1, 3)]
    assert pack(documents(spark, [])).collect() == []


LONG = [" " * 2_000_000 + "word", "a\n" + "\n" * 2_000_000, "x" + " \t" * 1_000_000 + "7" + "\u3000" * 300_000 + "!"]


@pytest.mark.parametrize("i", range(len(LONG)))
def test_long_runs_of_white_space(tokenizer, i):
    assert token_ids(default_ranks(), LONG[i]) == tokenizer.encode(LONG[i], add_special_tokens=False).ids


def test_a_document_with_a_long_run_is_packed(spark):
    pieces = pack(documents(spark, [LONG[0], "a b"])).collect()
    assert sum(p.length for p in pieces if p.doc_id == 0) == 2_000_001


def test_runs_are_cut_where_the_pattern_cuts(tokenizer, monkeypatch):
    """All short runs cut apart; characters that are white space only to Python stay in the matcher."""
    monkeypatch.setattr("tellerbook.llm.packing.RUN", 3)
    monkeypatch.setattr("tellerbook.llm.packing._LONG", re.compile(f"(?<!{SPACE}){SPACE}{{3,}}+"))
    for c in [*map(chr, range(0x3100)), "\ufeff"]:
        for text in (f"a  {c}  x", f"{c * 4}x", f"a{c * 5}", f" {c} \n!{c * 3}", f"q {c * 3} 's"):
            assert token_ids(default_ranks(), text) == tokenizer.encode(text, add_special_tokens=False).ids


END = "<|endoftext|>"
WITH_END = [f"x{END}", f"a {END} b", END * 3, f"{END}\n\n{END} c", f"<|end{END}oftext|>", " " * 200_000 + END + "\n" * 200_000 + "d"]


def test_the_added_token_is_one_token(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = [whole.encode(t, add_special_tokens=False).ids for t in WITH_END]
    assert [token_ids(default_ranks(), t) for t in WITH_END] == expected
    assert expected[0] == [87, 50256]
    found = {p.doc_id: p for p in pack(documents(spark, WITH_END[:2])).collect()}
    for i in range(2):
        ids = np.array([*expected[i], 0], "<u4")
        assert (found[i].doc_tokens, found[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([END, "a", " ", "\n", "<|", "|>", "endoftext", "é"]), max_size=30))
def test_added_tokens_anywhere(parts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = "".join(parts)
    assert token_ids(default_ranks(), text) == whole.encode(text, add_special_tokens=False).ids


def test_equal_rows_are_spread_over_lots(spark):
    frame = spark.range(100_000).selectExpr("CAST(NULL AS long) AS doc_id", "'the same few words' AS text")
    rows = pack(frame).selectExpr("sequence_id >> 32 AS lot", "length", "sequence_id").cache()
    assert rows.selectExpr("sum(length) AS n").head().n == 100_000 * 5
    largest = rows.groupBy("lot").count().selectExpr("max(count) AS n").head().n
    assert largest < 4 * packing.LOT
    rows.unpersist()

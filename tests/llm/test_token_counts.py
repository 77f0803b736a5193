import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, documents

from tellerbook.llm.token_counts import MARK, Unigram, default_vocabulary, token_counts


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer, models

    own = default_vocabulary()
    least = min(s for _, s in own)
    rest = [("<unk>", least)] + [(f"<0x{i:02X}>", least) for i in range(256)]
    return Unigram(own), Tokenizer(models.Unigram(rest + own, 0, True))


def expected(tokenizer, text):
    if not text:
        return 0
    return len(tokenizer.encode(MARK + text.replace(" ", MARK), add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("the andingé ▁  \n"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_counts_equal_the_unigram_tokenizer(both, text):
    model, tokenizer = both
    if "<" not in text:
        assert model.count(text)[0] == expected(tokenizer, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abc", max_size=9))
def test_best_score_and_ties_equal_brute_force(text):
    vocabulary = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("bb", -1.5)]
    scores, unknown = dict(vocabulary), -3.0 - 10.0

    def best(n):
        """Score and count up to n; of equal scores the longest last piece stays."""
        if n == 0:
            return 0.0, 0
        found = (-math.inf, 0)
        for start in range(n):
            piece = text[start:n]
            if piece in scores:
                s, c = best(start)
                if s + scores[piece] > found[0]:
                    found = (s + scores[piece], c + 1)
        if text[n - 1] not in scores:
            s, c = best(n - 1)
            if s + unknown > found[0]:
                found = (s + unknown, c + 1)
        return found

    score, count = best(len(text))
    assert Unigram(vocabulary).segment(text) == (count, score) if text else True


def test_tables(spark, both):
    _, tokenizer = both
    texts = [t for t in ODD if t is None or "<" not in t]
    found = {r.doc_id: r.n_tokens for r in token_counts(documents(spark, texts, extra=True)).collect()}
    assert found == {i: expected(tokenizer, t) for i, t in enumerate(texts)}
    assert token_counts(documents(spark, [])).collect() == []


def test_a_mark_inside_a_piece_is_refused():
    with pytest.raises(ValueError, match="mark"):
        Unigram([(f"a{MARK}b", -1.0)])

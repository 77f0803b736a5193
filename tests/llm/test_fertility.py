import math
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import ODD, documents, spoken

from tellerbook.llm import fertility
from tellerbook.llm.fertility import default_vocabulary, quality_rules, script

TEXT = st.text(alphabet="ab \t\n#é\x1f　", max_size=120)


def base(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    seen, lines = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            lines += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(inside), failed


def rows_of(frame):
    return {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in frame.collect()
    }


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(TEXT, min_size=40, max_size=60))
def test_base_counts_of_any_text(spark, texts):
    assert rows_of(quality_rules(documents(spark, texts))) == {i: base(t) for i, t in enumerate(texts)}


def test_odd_texts_and_empty_tables(spark):
    frame = documents(spark, ODD, extra=True)
    assert rows_of(quality_rules(frame)) == {i: base(t) for i, t in enumerate(ODD)}
    assert quality_rules(documents(spark, [])).collect() == []
    assert quality_rules(frame.union(frame)).count() == 2 * len(ODD)


@pytest.fixture(scope="module")
def judged(spark):
    import numpy as np

    random = np.random.default_rng(3)
    english = "the of and to in is was for that with from this have are not but they which his her".split()
    plain = [" ".join(random.choice(english, 60)) + f" number {i}" for i in range(200)]
    strange = ["ﬂŋƕ ƥƿǂ ȡȴɕ ʥʬ ᴂᴔ ᶀᶑ ḁḕ ẩỗ ἁἇ ὂὃ ₣₾ ℈℔ ⅋ ↈ ⌘ ⏏ " + f"n{i}" for i in range(3)]
    return {r.doc_id: r for r in quality_rules(documents(spark, plain + strange)).collect()}


def test_strange_texts_are_rejected_and_plain_ones_stay(judged):
    assert all(judged[i].kept for i in range(200))
    assert not any(judged[i].kept or judged[i].base_failed for i in range(200, 203))


def test_measures_equal_the_tokenizer(judged, spark):
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=default_vocabulary())
    text = documents(spark, [" ".join(spoken(__import__("numpy").random.default_rng(1), 50))])
    row = quality_rules(text).first()
    ids = pieces.encode(text.first().text)
    assert row.n_tokens == len(ids) and abs(row.chars_per_token - text.first().n_chars / len(ids)) < 1e-12


def test_scripts():
    assert script("привет мир") == "script: Cyrillic" and script("hello 你") == "script: Latin"
    assert script("12 %") == "script: none"


@pytest.mark.parametrize("near", [False, True])
def test_copies_of_one_text_do_not_narrow_the_bands(spark, random, near):
    """Two thirds of the rows are copies of one text; near copies have one word of their own."""
    short = "the of and to in is was for that with from this have are not but they his her she".split()
    long = "parliament information government understanding university department international development".split()

    def text(share, i):
        pick = [long if random.random() < share else short for _ in range(60)]
        return " ".join(p[int(random.integers(0, len(p)))] for p in pick) + f" number {i}"

    own = [text(i / 120, i) for i in range(120)]
    copied = own[0].split()
    copies = [" ".join([*copied[:k], f"y{i}", *copied[k + 1 :]]) if near else own[0] for i in range(240) for k in [i % 100]]
    alone = {r.doc_id for r in quality_rules(documents(spark, own)).collect() if r.kept}
    found = {r.doc_id for r in quality_rules(documents(spark, own + copies)).collect() if r.kept}
    assert len(alone) > 100 and alone <= found


def quartile(values, share):
    """The smallest value that at least this share of the values does not exceed."""
    values = sorted(values)
    return values[max(0, math.ceil(share * len(values)) - 1)]


def verdicts(rows, texts):
    """Every document's verdict, pool by pool."""
    passed = [r for r in rows if not r.base_failed]
    at = {r.doc_id: (r.lang, script(texts[r.doc_id]), int(math.log2(max(1, r.n_tokens)))) for r in rows}
    out = {}
    for r in rows:
        lang, own, doubling = at[r.doc_id]
        pools = (
            [p for p in passed if at[p.doc_id][::2] == (lang, doubling)],
            [p for p in passed if at[p.doc_id][0] == lang and abs(at[p.doc_id][2] - doubling) <= 1],
            [p for p in passed if at[p.doc_id][0] == lang],
            [p for p in passed if at[p.doc_id][1] == own],
        )
        pool = next((p for p in pools if len(p) >= fertility.ENOUGH), passed)
        kept = not r.base_failed
        for m in fertility.MEASURES if kept else ():
            low, middle, high = (quartile([p[m] for p in pool], q) for q in fertility.QUANTILES)
            below, above = (max(fertility.WIDTH * d, fertility.LEAST[m]) for d in (middle - low, high - middle))
            kept &= middle - below <= r[m] <= middle + above
        out[r.doc_id] = kept
    return out


def test_verdicts_equal_brute_force(spark, random):
    """Large and small classes of languages, scripts and lengths, some of one document alone."""
    vocabulary = {
        "en": "the of and to in is was for that with from this have are not but which his her parliament".split(),
        "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch".split(),
        "ru": "и в не на я быть он с что а по это она этот к но они мы весь который".split(),
    }
    junk = "qzx#vw kjq%xz zzxqj wqkzx ƕƥǂ xjqzk".split()
    texts, langs = [], []
    for lang, n in (("en", 150), ("de", 40), ("ru", 12)):
        for _ in range(n):
            length = int(2 ** random.uniform(4, 9))
            words = list(random.choice(vocabulary[lang], length))
            for _ in range(int(random.choice([0] * 11 + [length // 2]))):
                words[int(random.integers(length))] = str(random.choice(junk)) + str(random.integers(1000))
            texts.append(" ".join([*words, f"n{len(texts)}"]))
            langs.append(lang)
    texts += [" ".join(f"{random.choice(junk)}{i}" for i in range(14)), " ".join(random.choice(vocabulary["en"], 4000)), "one two"]
    langs += ["xx", "en", "en"]
    rows = [(i, t, lang) for i, (t, lang) in enumerate(zip(texts, langs, strict=True))]
    found = quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    expected = verdicts(found, texts)
    assert {r.doc_id: r.kept for r in found} == expected
    # The one document of its language is judged, and by others'.
    assert not expected[len(texts) - 3] and 100 < sum(expected.values()) < len(texts) - 3


def test_bands_are_joined_where_they_are_many(spark, random, monkeypatch):
    texts = [" ".join(spoken(random, 40)) for _ in range(50)] + ["ﬂŋƕ ƥƿǂ ȡȴɕ ʥʬ ᴂᴔ ᶀᶑ ḁḕ ẩỗ ἁἇ ὂὃ ₣₾ ℈℔ ⅋ ↈ ⌘ ⏏"]
    before = sorted(quality_rules(documents(spark, texts)).collect())
    monkeypatch.setattr(fertility, "FEW_CLASSES", 0)
    assert sorted(quality_rules(documents(spark, texts)).collect()) == before

import re

import pytest
from llm_helpers import ODD, documents, spoken

from tellerbook.llm import licenses
from tellerbook.llm.licenses import TEMPLATES, anchors, matching_blocks, needed, scan_licenses, tokens_of, words_of
from tellerbook.llm.queries import op12_license_scans


def brute(text, templates=TEMPLATES):
    """Every block against every template, set by set."""
    found = []
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for block, part in enumerate(re.split(r"\n[ \t-\r]*\n", lowered)):
        own = set(tokens_of(part)) if words_of(part) else set()
        for _number, (label, notice) in enumerate(templates):
            asked = set(tokens_of(notice))
            if 100 * len(own & asked) >= 80 * len(asked):
                found.append((block, label, len(own & asked) / len(asked)))
    return sorted(found)


def base(text):
    words = words_of(text or "")
    places = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split(" ")
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    return len(words), sorted(places)


def noisy(random, notice):
    """A notice with some words lost, changed or broken over lines."""
    words = notice.split(" ")
    for _ in range(int(random.choice([0, 0, 1, 2, 4]))):
        words[int(random.integers(len(words)))] = random.choice(["", "x", "license", "public license"])
    return "".join(w + random.choice([" ", " ", "\n// ", "  "]) for w in words)


def licensed_texts(random, n):
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(int(random.integers(1, 5))):
            parts.append(" ".join(spoken(random, int(random.integers(0, 30)))))
            if random.random() < 0.8:
                notice = noisy(random, TEMPLATES[int(random.integers(len(TEMPLATES)))][1])
                parts.append(notice.upper() if random.random() < 0.2 else notice)
            parts.append(random.choice(["MIT License", "apache  LICENSE", "general\npublic-license mit license", "the License"]))
        texts.append("".join(p + random.choice(["\n", "\n\n", " ", "\n \t\n"]) for p in parts))
    return texts


def test_scan_equals_brute_force(spark, random):
    texts = licensed_texts(random, 150) + ODD + ["MIT\nLicense", "mit license", "é mit license ß"]
    rows = scan_licenses(documents(spark, [*texts, texts[0], texts[0]], extra=True)).collect()
    assert len(rows) == len(texts) + 2
    matched = 0
    for r in rows:
        text = ([*texts, texts[0], texts[0]])[r.doc_id]
        n, places = base(text)
        expected = brute(text)
        assert (r.n_words, [tuple(p) for p in r.places]) == (n, places)
        assert [tuple(m) for m in r.matches] == expected
        assert r.labels == sorted({label for _, label in places} | {label for _, label, _ in expected})
        assert r.score == max((c for _, _, c in expected), default=0.0)
        matched += bool(expected)
    assert matched > 60


@pytest.mark.parametrize("percent", [40, 100])
def test_other_thresholds(spark, random, monkeypatch, percent):
    monkeypatch.setattr(licenses, "PERCENT", percent)
    texts = licensed_texts(random, 40)
    rows = matching_blocks(documents(spark, texts)).collect()
    expected = 0
    for text in texts:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for part in re.split(r"\n[ \t-\r]*\n", lowered):
            own = set(tokens_of(part)) if words_of(part) else set()
            expected += sum(100 * len(own & set(tokens_of(t))) >= percent * len(set(tokens_of(t))) for _, t in TEMPLATES)
    assert len(rows) == expected > 0


def test_anchors_are_in_every_block_that_can_match(random):
    words = anchors(TEMPLATES)
    assert not {"the", "this", "under"} & set(words)
    for _, notice in TEMPLATES:
        tokens = tokens_of(notice)
        assert sum(not any(word in t for word in words) for t in tokens) < needed(len(tokens))


def test_one_huge_block(spark, random):
    text = " ".join([*spoken(random, 150_000), "Released under the MIT License.", *spoken(random, 100_000)])
    r = scan_licenses(documents(spark, [text])).head()
    assert [tuple(m) for m in r.matches] == [(0, "mit", 1.0)] and [tuple(p) for p in r.places] == [(150_003, "mit")]


def test_null_ids_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "MIT license"), (None, None), (2, "MIT license")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.labels) for r in scan_licenses(frame).collect()) == [(0, []), (0, ["mit"]), (2, ["mit"])]
    assert scan_licenses(frame.limit(0)).collect() == []


def test_query(spark, tmp_path):
    texts = ["Under the Apache License, and the MIT license.\nThe MIT License", None, "Licensed under CC BY-NC 4.0."]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in op12_license_scans(spark, str(tmp_path)).collect()}
    assert tuple(rows[0]) == (0, 11, 3, 2, 9, "apache,mit", "apache,mit", 0.0)
    assert tuple(rows[1]) == (1, 0, 0, None, None, "", "", 0.0)
    assert tuple(rows[2]) == (2, 7, 0, None, None, "", "cc-by-nc", 1.0)


def test_no_python_in_the_plan(spark, random):
    plan = scan_licenses(documents(spark, licensed_texts(random, 5)).select("doc_id", "text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "InPandas" not in text

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tellerbook.llm import quotes
from tellerbook.llm.quotes import reply_ordered

SCHEMA = "conv_id long, turn long, role string, text string"


def run(spark, rows, schema=SCHEMA):
    found = reply_ordered(spark.createDataFrame(rows, schema)).collect()
    return {(r.conv_id, r.position): r for r in found}


def test_levels_links_and_texts(spark):
    rows = [
        (1, 0, "user", "Hello there\nhow are  you?\n\nSecond part."),
        (1, 1, "bot", "On Monday, Ann wrote:\n> hello there\n> how are you?\nFine, thanks."),
        (1, 2, "user", "> > Hello there how are you?\n> Fine, thanks.\nGood.\n"),
        (1, 300, "x", ">Second part.\nI see"),
        (1, 301, "y", "a > b"),
        (2, 0, "y", "> Good.\nwho?"),
    ]
    got = run(spark, rows)
    assert [got[1, i].text for i in range(5)] == [rows[0][3], "Fine, thanks.", "Good.", "I see", "a > b"]
    assert [got[1, i].reply_to for i in range(5)] == [None, 0, 1, 0, 300]
    assert got[1, 2].quoted == {1: 1, 2: 0} and got[1, 4].quoted is None
    # Another conversation's words are no source.
    assert (got[2, 0].reply_to, got[2, 0].text) == (None, "who?")
    assert got[1, 1].formatted == "<|bot|>\nFine, thanks.\n"


def brute(rows):
    """(conv, position) -> reply_to, for single-line passages."""
    def parts(text):
        own, quoted = set(), defaultdict(set)
        for line in text.split("\n"):
            marks = re.match(r"[> ]*", line)[0].count(">")
            words = " ".join(line.lstrip("> ").lower().split())
            if words:
                (quoted[marks] if marks else own).add(words)
        return own, quoted

    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], r[2], r[3]))
        for position, (_, turn, _, _) in enumerate(own):
            quoted = defaultdict(set)
            for level, words in ((k, v) for r in own if r[1] == turn for k, v in parts(r[3])[1].items()):
                quoted[level] |= words
            best = None
            for level in sorted(quoted, reverse=True):
                sources = [t for _, t, _, x in own if t < turn and parts(x)[0] & quoted[level]]
                best = max(sources) if sources else best
            if best is None:
                best = max((t for _, t, _, _ in own if t < turn), default=None)
            out[conv, position] = best
    return out


@pytest.mark.parametrize("stretch", [3, 256])
def test_links_equal_brute_force(spark, random, monkeypatch, stretch):
    """One conversation has most rows, one line is in most messages, and many quote it."""
    monkeypatch.setattr(quotes, "STRETCH", stretch)
    rows = []
    for _ in range(250):
        conv = 0 if random.random() < 0.6 else int(random.integers(1, 6))
        lines = [f"line {random.integers(0, 30)}", "very common"][: int(random.integers(1, 3))]
        if random.random() < 0.5:
            level = "> " * int(random.integers(1, 4))
            lines.append(level + ("Very  common" if random.random() < 0.5 else f"line {random.integers(0, 30)}"))
        rows.append((conv, int(random.integers(0, 60)), f"r{random.integers(0, 2)}", "\n".join(lines)))
    got = {k: r.reply_to for k, r in run(spark, rows).items()}
    assert got == brute(rows)


def test_no_reply_before_what_it_answers(spark, random):
    rows = [(int(i % 3), int(t), "r", f"line {t}") for i, t in enumerate(random.permutation(90))]
    found = run(spark, rows)
    at = {(r.conv_id, r.turn): r.position for r in found.values()}
    assert all(r.reply_to is None or at[r.conv_id, r.reply_to] < r.position for r in found.values())
    assert sorted(found) == [(c, p) for c in range(3) for p in range(30)]


def test_odd_rows(spark):
    long = "> q\n" * 20_000 + "w " * 50_000
    rows = [
        (1, 0, None, None, "a"), (1, 0, "r", "", "b"), (1, 0, "r", "", "b"), (1, 1, "r", long, "c"), (None, 1, "r", "> q\nz", "d"),
        (2, None, "r", "t", "e"), (3, -5, "r", ">", "f"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA + ", position string").withColumn("level", F.lit("clash"))
    found = reply_ordered(frame).collect()
    assert len(found) == len(rows)
    texts = sorted((r.conv_id or 0, r.position is None, len(r.text or "")) for r in found)
    assert texts == [(0, True, 1), (1, False, 0), (1, False, 0), (1, False, 0), (1, False, 99_999), (2, True, 1), (3, False, 0)]
    assert reply_ordered(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = reply_ordered(spark.createDataFrame([(1, 0, "r", "> x")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan

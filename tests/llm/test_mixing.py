from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tellerbook.llm import mixing
from tellerbook.llm.mixing import apportion, mix_plan, mixed, word_count

from llm_helpers import ODD, documents, spoken


def sainte_lague(votes, seats):
    won = Counter()
    for _ in range(seats):
        won[max(votes, key=lambda k: (Fraction(votes[k], 2 * won[k] + 1), -k))] += 1
    return {k: won[k] for k in votes}


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 1237])
def test_seats_go_by_highest_quotients(spark, random, seats):
    votes = {i: int(random.integers(1, 5000)) for i in range(13)} | {13: 0}
    frame = spark.createDataFrame([("g", k, v, seats) for k, v in votes.items()], "g string, k long, v long, s long")
    got = {r.k: r.quota for r in apportion(frame, ["g"], "k", "v", "s").collect()}
    assert got == sainte_lague(votes, seats)


def water_fill(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / rest if rest else 0
        over = {s for s in names if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def test_targets_and_sizes(spark, random):
    rows = [
        (i, " ".join(spoken(random, int(random.integers(0, 300)))), ["a", "b", "é", None, "zz"][int(random.integers(0, 5)) ** 2 % 5])
        for i in range(300)
    ]
    rows += [(1000, None, "a"), (1001, "", "empty")]
    found = mix_plan(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(found) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = water_fill(sizes)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - float(want[r.source])) < 1e-6
    for source, target in want.items():
        assert abs(taken[source] - target) <= 64 * 2


def test_the_mix_holds_the_words_taken(spark, random):
    frame = documents(spark, [" ".join(spoken(random, int(random.integers(1, 400)))) for _ in range(60)], extra=True)
    frame = frame.union(frame.limit(3))
    plan = Counter()
    for r in mix_plan(frame).collect():
        plan[r.doc_id] += r.taken
    out = mixed(frame)
    assert out.columns == frame.columns
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum(word_count("text")).alias("n")).collect()}
    assert got == {k: n for k, n in plan.items() if n}
    assert out.where("n_chars != length(text) OR size != 'kept'").count() == 0


def test_reruns_and_partitions_agree(spark, random):
    frame = documents(spark, [" ".join(spoken(random, 50 + i)) for i in range(80)])
    one = sorted(mix_plan(frame).select("doc_id", "taken").collect())
    assert one == sorted(mix_plan(frame.repartition(7)).select("doc_id", "taken").collect())


def test_odd_and_empty_tables(spark):
    assert mix_plan(documents(spark, [])).collect() == []
    assert mixed(documents(spark, [])).collect() == []
    nothing = mix_plan(documents(spark, [None, "", " "])).collect()
    assert [(r.size, r.taken, r.target) for r in nothing] == [(0, 0, 0.0)] * 3
    rows = mix_plan(documents(spark, ODD, extra=True)).collect()
    assert len(rows) == len(ODD) and {r.doc_id: r.size for r in rows}[7] == 40_000


def test_rows_without_ids_are_spread_and_joined_one_to_one(spark):
    frame = spark.range(100_000).selectExpr(
        "CAST(NULL AS long) AS doc_id", "'the same few words here' AS text", "'en' AS lang", "'s' AS source", "CAST(23 AS long) AS n_chars"
    )
    plan = mix_plan(frame)
    sizes = plan.groupBy("shard").count().selectExpr("max(count) AS most", "count(*) AS shards").head()
    assert sizes.shards > 150 and sizes.most < 4 * mixing.SHARD_DOCUMENTS
    total = plan.selectExpr("sum(taken) AS n").head().n
    words = mixing.word_count("text")
    assert mixed(frame).select(words.alias("n")).selectExpr("sum(n) AS n").head().n == total
    assert abs(total - 750_000) < 75_000

import pytest
from pyspark.sql import functions as F
from helpers import event, rows
from test_pipeline import Book

import tellerbook.plans.pipeline as pipeline
from tellerbook.operators.drift import amount_sketches, check_drift, compare_runs, rank_distance, read_runs, write_run
from tellerbook.operators.quality import QualityError


def silver(spark, amounts, kind="PIX"):
    return spark.createDataFrame([(kind, float(a)) for a in amounts], "transaction_type string, amount_usd double")


def failing(now, before, **options):
    return check_drift(now, before, **options).head().failing_rows


def exact(a, b):
    values = sorted({*a, *b})
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in values)


@pytest.mark.parametrize("shift", [0, 100, 500, 5000])
def test_the_distance_is_that_of_ranks(spark, shift):
    a, b = list(range(1000)), [x * 0.9 + shift for x in range(700)]
    pair = amount_sketches(silver(spark, a)).select(F.col("sketch").alias("x")).crossJoin(
        amount_sketches(silver(spark, b)).select(F.col("sketch").alias("y"))
    )
    found = pair.select(rank_distance("x", "y")).head()[0]
    assert abs(found - exact(a, b)) < 0.015


def test_many_equal_amounts(spark):
    a, b = [5.0] * 900 + [7.0] * 100, [5.0] * 500 + [7.0] * 500
    both = [amount_sketches(silver(spark, x)) for x in (a, b)]
    assert abs(compare_runs(*both).head().distance - 0.4) < 0.015
    assert compare_runs(both[0], both[0]).head().distance == 0


def test_runs_are_kept_and_united(spark, folder):
    root = f"{folder}/runs"
    assert read_runs(spark, root).collect() == []
    for run in range(3):
        write_run(amount_sketches(silver(spark, range(run * 100, run * 100 + 100))), root, run)
    write_run(amount_sketches(silver(spark, range(200, 300))), root, 2)
    assert [tuple(r) for r in read_runs(spark, root).select("n").collect()] == [(300,)]
    assert [tuple(r) for r in read_runs(spark, root, last=1).select("n").collect()] == [(100,)]
    now = amount_sketches(silver(spark, range(300)))
    assert failing(now, read_runs(spark, root)) == 0
    assert failing(now, read_runs(spark, root, last=1)) == 300


def test_what_passes(spark):
    base = amount_sketches(silver(spark, range(1000)))
    assert failing(base, base) == 0
    assert failing(amount_sketches(silver(spark, [3.0, 900.0])), base) == 0
    assert failing(amount_sketches(silver(spark, range(9000, 9500), "NEW")), base) == 0
    assert failing(base, amount_sketches(silver(spark, []))) == 0
    assert failing(amount_sketches(silver(spark, [])), base) == 0
    odd = silver(spark, [float("nan"), float("inf"), *range(1000)])
    assert failing(amount_sketches(odd), base) == 0
    line = check_drift(amount_sketches(silver(spark, range(5000, 5500))), base, level="warn").head()
    assert tuple(line) == ("drift:amount_usd", "warn", 500)


def test_a_type_without_a_name(spark):
    base = amount_sketches(silver(spark, range(500), None))
    assert failing(amount_sketches(silver(spark, range(2000, 2500), None)), base) == 500


def test_the_gate_closes_and_keeps_the_old_run(spark, folder):
    book, runs = Book(spark, folder), f"{folder}/runs"
    book.append([event(str(i), amount=float(i)) for i in range(300)])
    results = book.rebuild(runs_root=runs)
    assert results[-1] == ("drift:amount_usd", "error", 0)
    gold = book.gold_rows()
    book.append([event(f"x{i}", amount=i + 5000.0) for i in range(300)])
    with pytest.raises(QualityError, match="drift"):
        book.rebuild(runs_root=runs)
    assert book.gold_rows() == gold and len(rows(read_runs(spark, runs))) == 1
    assert pipeline.read_gold(spark, book.gold).count()

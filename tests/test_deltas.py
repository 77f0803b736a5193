import random

import pytest
from helpers import event, rows
from pyspark.sql import functions as F
from test_pipeline import Book

import tellerbook.plans.deltas as deltas
import tellerbook.plans.pipeline as pipeline
from tellerbook.operators.gold import gold_account_summary
from tellerbook.operators.quality import QualityError
from tellerbook.operators.silver import build_silver
from tellerbook.plans import index, stored
from tellerbook.schemas import KEY, SILVER
from tellerbook.sources.bronze import read_bronze
from tellerbook.sources.tables import exists

BUCKETS = 8


class DeltaBook(Book):
    def refresh_deltas(self, items):
        self.append(items)
        return deltas.refresh_gold_deltas(self.spark, self.fresh(), self.silver, self.gold)

    def expected(self):
        silver = build_silver(read_bronze(self.spark, self.bronze))
        return rows(silver.select(*SILVER.fieldNames())), rows(gold_account_summary(silver, unique_ids=True))

    def check(self):
        assert (self.silver_rows(), self.gold_rows()) == self.expected()


@pytest.fixture
def book(spark, folder):
    return DeltaBook(spark, folder)


def start(book, items):
    book.append(items)
    book.rebuild(buckets=BUCKETS)


def some_events(rng, n, ids):
    return [
        event(
            f"t{rng.randrange(ids)}",
            f"2026-07-{rng.randint(1, 9):02d}T{rng.randint(0, 23):02d}:00:00",
            rng.choice([5.0, 12.25, 20_000.0, 10_000.01]),
            sender_account=f"{rng.randint(100, 104)}-00000",
            transaction_type=rng.choice(["PIX", "TED"]),
        )
        for _ in range(n)
    ]


def test_corrections_move_day_account_and_type(book):
    start(book, [event("a"), event("b"), event("c", amount=20_000.0), event("d", "2026-07-01T00:00:00")])
    moved = [
        event("a", "2026-07-20T00:00:00"),
        event("b", "2026-07-07T13:00:00", sender_account="999-00000"),
        event("c", "2026-07-07T13:00:00", transaction_type="TED"),
        event("d", "2026-07-02T00:00:00", amount=1.0),
        event("e", "2026-07-03T00:00:00"),
    ]
    assert book.refresh_deltas(moved) == 5
    book.check()
    assert not exists(book.spark, f"{book.gold}/version=1/date_transaction=2026-07-01")
    # The same rows, older ones and equal ones change nothing.
    before = book.gold_rows()
    assert book.refresh_deltas([*moved, event("a", "2026-01-01T00:00:00")]) == 0
    assert book.gold_rows() == before
    assert len(stored.change_numbers(book.spark, book.silver, 1)) == 1


def test_many_batches_equal_a_rebuild(book):
    rng = random.Random(5)
    start(book, some_events(rng, 60, 40))
    for step in range(4):
        book.refresh_deltas(some_events(rng, 25, 60))
        book.check()
        if step == 1:
            assert deltas.fold_changes(book.spark, book.silver, book.gold) == 2
            book.check()
    # A refresh by dates goes on from there, and deltas again after it.
    book.append(some_events(rng, 10, 60))
    book.refresh()
    book.check()
    book.refresh_deltas(some_events(rng, 10, 60))
    book.check()


def test_amounts_that_are_no_cents_and_null_times(book):
    start(book, [event("a", amount=1.005), event("b", amount=0.1), event("c", amount=1e-9)])
    book.refresh_deltas([event("a", "2026-07-07T13:00:00", 2.5), event("c", "2026-07-07T13:00:00", 0.25)])
    book.check()
    book.refresh_deltas([event("b", "2026-07-08T13:00:00", 1 / 3)])
    book.check()


def test_gate_commits_nothing(book):
    start(book, [event("a")])
    before = book.gold_rows()
    with pytest.raises(QualityError):
        book.refresh_deltas([event("a", "2026-07-08T00:00:00", float("inf"))])
    assert stored.change_numbers(book.spark, book.silver, 1) == [] and book.gold_rows() == before


def test_without_parts_it_is_refused(book):
    book.append([event("a")])
    book.rebuild()
    with pytest.raises(ValueError, match="buckets"):
        book.refresh_deltas([event("b")])


@pytest.mark.parametrize("stop_at", ["replace_dates", "make_folder", "gold_from_parts", "dates_of"])
def test_interrupted_runs_are_finished_by_the_next(book, monkeypatch, stop_at):
    rng = random.Random(6)
    start(book, some_events(rng, 40, 30))
    items = some_events(rng, 20, 40)
    whole = getattr(deltas, stop_at)
    for allowed in range(4):
        calls = iter(range(allowed))

        def stops(*args, calls=calls, **options):
            if next(calls, None) is None:
                raise KeyboardInterrupt
            return whole(*args, **options)

        monkeypatch.setattr(deltas, stop_at, stops)
        try:
            book.refresh_deltas(items)
        except KeyboardInterrupt:
            pass
        monkeypatch.setattr(deltas, stop_at, whole)
    deltas.refresh_gold_deltas(book.spark, book.fresh(), book.silver, book.gold)
    book.check()


@pytest.mark.parametrize("stop_at", ["replace_dates", "update_index", "remove_folder"])
def test_interrupted_fold_shows_the_same_rows(book, monkeypatch, stop_at):
    rng = random.Random(7)
    start(book, some_events(rng, 40, 30))
    book.refresh_deltas(some_events(rng, 20, 40))
    book.refresh_deltas(some_events(rng, 20, 40))

    def stops(*args, **options):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(deltas, stop_at, stops)
        with pytest.raises(KeyboardInterrupt):
            deltas.fold_changes(book.spark, book.silver, book.gold)
    book.check()
    deltas.fold_changes(book.spark, book.silver, book.gold)
    book.check()
    assert stored.change_numbers(book.spark, book.silver, 1) == []
    book.refresh_deltas(some_events(rng, 20, 50))
    book.check()


def folders(frame):
    return {r[0].rsplit("/", 2)[-2] for r in frame.select(F.col("_metadata.file_path")).distinct().collect()}


def test_index_reads_only_the_buckets_of_its_ids(book):
    spark = book.spark
    start(book, [event(f"t{i}", f"2026-07-{1 + i % 20:02d}T00:00:00") for i in range(300)])
    assert index.index_buckets(spark, book.silver, 1) == BUCKETS
    ids = spark.createDataFrame([("t5",), ("t6",), ("absent",)], f"{KEY} string")
    buckets = {f"bucket={r[0]}" for r in ids.select(index._bucket(BUCKETS)).collect()}
    assert folders(index.index_of(spark, book.silver, 1, BUCKETS, ids)) == buckets and len(buckets) < BUCKETS
    base = stored.read_base(spark, book.silver, 1)
    found = index.find(spark, base, book.silver, 1, ids)
    assert rows(found.select(KEY, F.col("date_transaction").cast("string"))) == [("t5", "2026-07-06"), ("t6", "2026-07-07")]


def test_index_follows_the_rows(book):
    start(book, [event("a"), event("b")])
    book.append([event("a", "2026-07-09T00:00:00"), event("c", "2026-07-10T00:00:00")])
    book.refresh()
    base = stored.read_base(book.spark, book.silver, 1)
    found = index.find(book.spark, base, book.silver, 1, base.select(KEY))
    assert rows(found) == rows(base.select(KEY, "date_transaction"))


def test_only_changed_ids_of_silver_are_read(book):
    spark = book.spark
    start(book, [event(f"t{i}", f"2026-07-{1 + i % 20:02d}T00:00:00") for i in range(300)])
    ids = spark.createDataFrame([("t5",), ("t25",), ("t6",)], f"{KEY} string")
    read = deltas.stored_rows(spark, book.silver, 1, ids)
    assert sorted(r[0] for r in read.select(KEY).collect()) == ["t25", "t5", "t6"]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [date_transaction" in plan and "PartitionFilters: [bucket" in plan
    assert {day for day in range(1, 21) if f"2026-07-{day:02d}" in plan} == {6, 7}



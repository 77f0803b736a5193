import random
from datetime import date

import pytest
from helpers import event, event_rows, gold_by_hand, lands, rows
from pyspark.sql import functions as F
from test_silver_gold import many_events

import tellerbook.plans.pipeline as pipeline
from tellerbook.operators.quality import QualityError
from tellerbook.operators.silver import build_silver
from tellerbook.plans import stored as stored_layers
from tellerbook.schemas import GOLD, SILVER
from tellerbook.sources.bronze import append_bronze, read_bronze
from tellerbook.sources.events import read_events
from tellerbook.streaming.ingest import run_ingest


class Book:
    """Bronze, silver and gold folders of one test."""

    def __init__(self, spark, folder):
        self.spark, self.batches = spark, 0
        self.bronze, self.silver, self.gold = (
            f"{folder}/{n}" for n in ("bronze", "silver", "gold")
        )

    def append(self, items):
        append_bronze(event_rows(self.spark, items), self.bronze, self.batches)
        self.batches += 1

    def rebuild(self, **options):
        return pipeline.run_pipeline(
            self.spark, self.bronze, self.silver, self.gold, **options
        )

    def fresh(self):
        return read_bronze(self.spark, self.bronze).where(
            F.col("batch_id") == self.batches - 1
        )

    def refresh(self, **options):
        return pipeline.refresh_gold_dates(
            self.spark, self.fresh(), self.silver, self.gold, **options
        )

    def gold_rows(self):
        return rows(pipeline.read_gold(self.spark, self.gold))

    def silver_rows(self):
        return rows(
            pipeline.read_silver(self.spark, self.silver).select(*SILVER.fieldNames())
        )


@pytest.fixture
def book(spark, folder):
    return Book(spark, folder)


def test_pipeline_and_its_report(book):
    items = many_events(1)
    book.append(items)
    report = book.rebuild()
    assert book.gold_rows() == gold_by_hand(items)
    failing = {check: n for check, level, n in report if level == "error"}
    assert set(failing.values()) == {0}
    assert "unique:transaction_id" in failing
    assert "not_null:transaction_id" in failing


def test_gate_leaves_the_old_gold(book):
    book.append([event("a")])
    book.rebuild()
    before = book.gold_rows()
    book.append([event("b", amount=float("inf"))])
    with pytest.raises(QualityError, match="amount_finite"):
        book.rebuild()
    assert book.gold_rows() == before
    # The refresh starts from the silver the gold was made of.
    book.append([event("c", "2026-07-08T00:00:00")])
    assert book.refresh() == [date(2026, 7, 8)]
    assert sum(r[3] for r in book.gold_rows()) == 2
    book.rebuild(checks=[])
    assert sum(r[3] for r in book.gold_rows()) == 3


def test_failed_write_leaves_the_old_gold(book, monkeypatch):
    book.append([event("a")])
    book.rebuild()
    before = book.gold_rows()
    poison = pipeline.read_gold(book.spark, book.gold).withColumn(
        "account_id", F.raise_error(F.lit("lost")).cast("string")
    )
    with pytest.raises(Exception, match="lost"):
        pipeline.write_gold(poison, book.gold)
    assert book.gold_rows() == before


def test_empty_pipeline(book):
    book.append([])
    book.rebuild()
    assert book.gold_rows() == []
    frame = pipeline.read_gold(book.spark, book.gold)
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in GOLD]


def test_gold_is_partitioned_by_date(book):
    book.append([event("a"), event("b", "2026-07-09T00:00:00")])
    book.rebuild()
    frame = pipeline.read_gold(book.spark, book.gold).where("date_transaction = '2026-07-09'")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "date_transaction" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert frame.count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_refresh_equals_rebuild(book, seed):
    rng = random.Random(seed)
    items = many_events(seed, 150)
    rng.shuffle(items)
    first, second, third = items[:80], items[80:140], items[140:]
    book.append(first)
    book.rebuild()
    for part in (second, third):
        book.append(part)
        book.refresh()
    assert book.gold_rows() == gold_by_hand(items)
    assert book.silver_rows() == rows(build_silver(event_rows(book.spark, items)))


def test_refresh_touches_only_the_dates_concerned(book, tmp_path):
    days = [event(str(d), f"2026-07-0{d}T08:00:00") for d in range(1, 8)]
    book.append(days)
    book.rebuild()
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet")}
    book.append([event("2", "2026-07-05T09:00:00"), event("n", "2026-07-06T01:00:00")])
    assert book.refresh() == [date(2026, 7, 2), date(2026, 7, 5), date(2026, 7, 6)]
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "gold").rglob("*.parquet")}
    kept = {p.parent.name[-2:] for p in files if now.get(p) == files[p]}
    assert kept == {"01", "03", "04", "07"}
    assert not list((tmp_path / "gold").rglob("*=2026-07-02/*.parquet"))
    assert book.gold_rows() == gold_by_hand([*days, *book_items(book)])


def test_date_list_prunes_stored_silver(book):
    book.append([event("a"), event("b", "2026-07-09T00:00:00"), event("c", "None")])
    book.rebuild(checks=[])
    stored = pipeline.read_silver(book.spark, book.silver)
    for dates, found in (([date(2026, 7, 9)], {"b"}), ([None, date(2026, 7, 7)], {"a", "c"})):
        frame = stored.where(pipeline._on_dates(dates))
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "date_transaction" in plan[plan.index("PartitionFilters") :].split("Pushed")[0]
        assert {r.transaction_id for r in frame.collect()} == found


def book_items(book):
    """The last batch as event dicts."""
    return [r.asDict() for r in book.fresh().collect()]


def test_refresh_with_redelivery_or_nothing_is_a_no_op(book):
    items = many_events(4, 60)
    book.append(items)
    book.rebuild()
    book.append(items[:20])
    assert book.refresh() == []
    book.append([])
    assert book.refresh() == []
    assert book.gold_rows() == gold_by_hand(items)


def test_refresh_with_rows_without_a_time(book):
    book.append([event("a", "None"), event("b")])
    book.rebuild(checks=[])
    book.append([event("a"), event("c", "None")])
    assert book.refresh(checks=[]) == [date(2026, 7, 7), None]
    seen = {(r[0], r[3]) for r in book.gold_rows()}
    assert seen == {(date(2026, 7, 7), 2), (None, 1)}
    book.append([event("c")])
    book.refresh()
    assert {(r[0], r[3]) for r in book.gold_rows()} == {(date(2026, 7, 7), 3)}


@pytest.mark.parametrize("fail_at", range(1, 7))
def test_interrupted_refresh_can_be_repeated(book, monkeypatch, fail_at):
    """Stop before or after each change to the stored tables, then run again."""
    old = [event(str(i), f"2026-07-0{1 + i % 4}T08:00:00") for i in range(12)]
    moved = [event(str(i), f"2026-07-0{5 + i % 3}T08:00:00", 20_000.0) for i in (0, 4, 8, 1)]
    book.append(old)
    book.rebuild()
    book.append(moved)
    done = 0

    def stopping(change):
        def run(*args, **kwargs):
            nonlocal done
            done += 1
            if done == fail_at:
                raise OSError("executor lost")
            return change(*args, **kwargs)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(stored_layers, "remove_folder", stopping(stored_layers.remove_folder))
        patch.setattr(stored_layers, "write_daily", stopping(stored_layers.write_daily))
        try:
            book.refresh()
        except OSError:
            pass
    book.refresh()
    assert book.gold_rows() == gold_by_hand(old + moved)
    assert book.silver_rows() == rows(build_silver(event_rows(book.spark, old + moved)))


def test_half_replaced_silver_heals(book, tmp_path):
    """Some date folders were replaced and others not when the run stopped."""
    old = [event("a", "2026-07-01T08:00:00"), event("b", "2026-07-01T09:00:00")]
    moved = [event("a", "2026-07-02T08:00:00")]
    book.append(old)
    book.rebuild()
    (silver,) = (tmp_path / "silver").glob("version=*")
    kept = {p.name: p.read_bytes() for p in silver.glob("*=2026-07-01/*.parquet")}
    book.append(moved)
    book.refresh()
    target = silver / "date_transaction=2026-07-01"
    for p in [*target.glob("*.parquet"), *target.glob(".*.crc")]:
        p.unlink()
    for name, data in kept.items():
        (target / name).write_bytes(data)
    assert len(book.silver_rows()) == 3
    book.refresh()
    assert book.gold_rows() == gold_by_hand(old + moved)
    assert len(book.silver_rows()) == 2


def test_backfill_of_an_outage(spark, folder, book):
    live = [event(f"l{d}", f"2026-07-{d:02d}T10:00:00") for d in (5, 6, 13, 14)]
    landing, checkpoint = f"{folder}/landing", f"{folder}/c"
    lands(landing, "live.json", live)
    run_ingest(spark, landing, book.bronze, checkpoint)
    book.rebuild()
    pipeline.backfill(spark, landing, book.bronze, checkpoint, per_day=20, seed=1)
    late = read_bronze(spark, book.bronze).where("batch_id > 0")
    assert late.count() == 120
    dates = pipeline.refresh_gold_dates(spark, late, book.silver, book.gold)
    assert dates == [date(2026, 7, d) for d in range(7, 13)]
    items = [r.asDict() for r in read_bronze(spark, book.bronze).collect()]
    assert book.gold_rows() == gold_by_hand(items)
    assert read_events(spark, landing).count() == 124
    before = book.gold_rows()
    book.rebuild()
    assert book.gold_rows() == before


def test_the_gate_stands_before_a_refresh(spark, book):
    book.append([event("a"), event("b", "2026-07-08T12:00:00")])
    book.rebuild()
    silver, gold = book.silver_rows(), book.gold_rows()
    book.append([event("c", amount=float("inf"))])
    with pytest.raises(QualityError):
        book.refresh()
    assert (book.silver_rows(), book.gold_rows()) == (silver, gold)

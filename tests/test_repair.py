import random
from datetime import date

import pytest
from helpers import event, gold_by_hand, lands, rows

import tellerbook.streaming.repair as repair
from tellerbook.plans.pipeline import read_gold, read_silver
from tellerbook.plans.stored import change_numbers
from tellerbook.sources.bronze import read_quarantine
from tellerbook.streaming.repair import LiveGold, run_live_gold


@pytest.fixture
def live(spark, folder):
    return LiveGold(spark, f"{folder}/live", buckets=4, fold_after=3)


def deliver(live, folder, name, items):
    lands(f"{folder}/landing", name, items)
    run_live_gold(live, f"{folder}/landing")


def gold(live):
    return rows(read_gold(live.spark, live.gold))


def on(day, id, amount=100.0, **changes):
    return event(id, f"2026-07-{day:02d}T10:00:00", amount, **changes)


def test_days_close_and_late_rows_repair_them(live, folder):
    first = [on(1, "a"), on(2, "b"), on(3, "c"), on(4, "d")]
    deliver(live, folder, "1.json", first)
    # A lateness of one day: the third and fourth are open.
    assert gold(live) == gold_by_hand(first[:2])
    late = [on(1, "e", 20_000.0), on(2, "a"), on(4, "f")]
    deliver(live, folder, "2.json", late)
    assert gold(live) == gold_by_hand(first[:2] + late[:2])
    last = [on(6, "g"), on(1, "h")]
    deliver(live, folder, "3.json", last)
    assert gold(live) == gold_by_hand(first + late + last[1:])
    live.close_days()
    assert gold(live) == gold_by_hand(first + late + last)


def test_any_order_of_arrival_equals_the_batch(live, folder):
    rng = random.Random(4)
    items = [
        on(rng.randint(1, 20), f"t{rng.randrange(60)}", rng.choice([5.0, 12.25, 20_000.0]), sender_account=f"{rng.randint(100, 103)}-00000")
        for _ in range(150)
    ]
    for i in range(5):
        deliver(live, folder, f"{i}.json", items[30 * i : 30 * i + 30])
    live.close_days()
    assert gold(live) == gold_by_hand(items)
    version = 1
    assert len(change_numbers(live.spark, live.silver, version)) < live.fold_after
    assert read_silver(live.spark, live.silver).count() == len({i["transaction_id"] for i in items})


@pytest.mark.parametrize("stop_at", ["append_bronze", "refresh_gold_deltas", "remove_folder"])
def test_a_batch_taken_again_changes_nothing(live, folder, monkeypatch, stop_at):
    first = [on(d, f"a{d}") for d in range(1, 6)]
    deliver(live, folder, "1.json", first)
    second = [on(2, "late"), on(9, "b"), on(4, "a1")]
    whole = getattr(repair, stop_at)

    def stops(*args, **options):
        whole(*args, **options)
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(repair, stop_at, stops)
        with pytest.raises(Exception, match="executor lost"):
            deliver(live, folder, "2.json", second)
    run_live_gold(live, f"{folder}/landing")
    live.close_days()
    assert gold(live) == gold_by_hand(first + second)


def test_bad_lines_and_empty_batches(live, folder):
    deliver(live, folder, "1.json", ["nonsense", event("a", "None")])
    assert gold(live) == [] and read_quarantine(live.spark, live.bronze).count() == 2
    deliver(live, folder, "2.json", [on(3, "b")])
    deliver(live, folder, "3.json", ["nonsense"])
    live.close_days()
    assert [r[0] for r in gold(live)] == [date(2026, 7, 3)]

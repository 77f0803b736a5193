import os
from datetime import UTC, datetime, timedelta

import pytest
from helpers import event, lands, rows

from tellerbook.sources.bronze import read_bronze, read_quarantine
from tellerbook.sources.replay import last_arrival, read_events_between, replay
from tellerbook.streaming.ingest import run_ingest

START = datetime(2026, 7, 1, tzinfo=UTC)


def lands_at(folder, name, items, day):
    lands(folder, name, items)
    moment = (START + timedelta(days=day)).timestamp()
    os.utime(f"{folder}/{name}", (moment, moment))


@pytest.fixture
def landing(folder):
    """One file a day, four days."""
    path = f"{folder}/landing"
    for day in range(4):
        lands_at(path, f"{day}.json", [event(f"{day}-{i}") for i in range(3)] + [f"bad line {day}"], day)
    return path


def window(first, last):
    return START + timedelta(days=first, hours=-1), START + timedelta(days=last, hours=1)


def ids(spark, bronze):
    return sorted(r.transaction_id for r in read_bronze(spark, bronze).collect())


def test_only_the_window_is_read(spark, landing, other_zone):
    found = read_events_between(spark, landing, *window(1, 2))
    assert found.count() == 8 and len(found.inputFiles()) == 2
    assert last_arrival(spark, landing) == START + timedelta(days=3)


def test_bronze_gains_only_what_it_lacks(spark, landing, folder):
    bronze = f"{folder}/bronze"
    lands_at(f"{folder}/part", "2.json", [event("2-0"), event("2-1"), "bad line 2"], 2)
    run_ingest(spark, f"{folder}/part", bronze, f"{folder}/c")
    assert replay(spark, landing, bronze, *window(1, 2)) == 5
    assert ids(spark, bronze) == ["1-0", "1-1", "1-2", "2-0", "2-1", "2-2"]
    assert sorted(r.value for r in read_quarantine(spark, bronze).collect()) == ["bad line 1", "bad line 2"]
    # Again, and a wider window: only the other days.
    assert replay(spark, landing, bronze, *window(1, 2)) == 0
    assert replay(spark, landing, bronze, *window(0, 3)) == 8
    assert len(ids(spark, bronze)) == 12 and read_quarantine(spark, bronze).count() == 4


def test_an_interrupted_replay_is_repeated(spark, landing, folder, monkeypatch):
    import tellerbook.sources.replay as module

    bronze = f"{folder}/bronze"
    whole = module.append_bronze

    def stops(*args, **options):
        whole(*args, **options)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "append_bronze", stops)
        with pytest.raises(OSError):
            replay(spark, landing, bronze, *window(0, 1))
    assert replay(spark, landing, bronze, *window(0, 1)) == 0
    assert len(ids(spark, bronze)) == 6


def test_equal_fields_apart_from_nulls_are_told_apart(spark, folder):
    landing, bronze = f"{folder}/landing", f"{folder}/bronze"
    lands_at(landing, "a.json", [event("a", sender_account="1"), event("a", receiver_account="1"), event("a", amount=0.0)], 0)
    assert replay(spark, landing, bronze, *window(0, 0)) == 3
    assert replay(spark, landing, bronze, *window(0, 0)) == 0


def test_an_empty_window(spark, landing, folder):
    assert replay(spark, landing, f"{folder}/bronze", *window(20, 30)) == 0
    os.makedirs(f"{folder}/none")
    assert last_arrival(spark, f"{folder}/none") is None
    assert rows(read_bronze(spark, f"{folder}/bronze")) == []

from helpers import bronze, event, gold_by_hand, lands, rows
from pyspark.sql import functions as F
from test_silver_gold import many_events

from tellerbook.operators.gold import gold_account_summary
from tellerbook.operators.silver import build_silver
from tellerbook.schemas import SILVER
from tellerbook.sources.events import accepted, parse_events, read_event_stream
from tellerbook.streaming.daily import (
    read_stream_gold,
    read_stream_latest,
    rows_dropped_by_watermark,
    stream_dedup,
    stream_gold,
    stream_latest,
    stream_silver,
    write_updates,
)


def silver_stream(spark, folder, max_files=1):
    lines = read_event_stream(spark, f"{folder}/landing", max_files)
    return stream_silver(accepted(parse_events(lines)))


def daily(spark, folder, **options):
    """Gold on the stream, one file per trigger: (rows, late rows)."""
    unique = stream_dedup(silver_stream(spark, folder), **options)
    query = write_updates(stream_gold(unique), f"{folder}/gold", f"{folder}/c")
    return rows(read_stream_gold(spark, f"{folder}/gold")), rows_dropped_by_watermark(query)


OLD_DAY = [event("a"), event("b", "2026-07-07T13:00:00"), event("a")]
NEW_DAY = [event("c", "2026-07-12T12:00:00")]


def test_days_in_order(spark, folder):
    lands(f"{folder}/landing", "0.json", OLD_DAY)
    lands(f"{folder}/landing", "1.json", NEW_DAY)
    assert daily(spark, folder, watermark="1 day") == (gold_by_hand(OLD_DAY + NEW_DAY), 0)


def test_late_day_beyond_the_watermark_is_reported(spark, folder):
    lands(f"{folder}/landing", "0.json", NEW_DAY)
    lands(f"{folder}/landing", "1.json", [event("d", "2026-07-12T13:00:00")])
    lands(f"{folder}/landing", "2.json", OLD_DAY)
    seen, late = daily(spark, folder, watermark="1 day", spread=1)
    assert seen == gold_by_hand([*NEW_DAY, event("d", "2026-07-12T13:00:00")])
    assert late > 0


def test_late_day_within_the_default_watermark_counts(spark, folder):
    lands(f"{folder}/landing", "0.json", NEW_DAY)
    lands(f"{folder}/landing", "1.json", OLD_DAY)
    assert daily(spark, folder) == (gold_by_hand(OLD_DAY + NEW_DAY), 0)


def test_redelivery_across_triggers_counts_once(spark, folder):
    items = [event(str(i), f"2026-07-0{1 + i % 5}T10:00:00", 20_000.0 + i) for i in range(20)]
    for n in range(3):
        lands(f"{folder}/landing", f"{n}.json", items)
    assert daily(spark, folder) == (gold_by_hand(items), 0)


def test_dedup_with_a_hot_id_and_without_spreading(spark, folder):
    items = [event("hot")] * 60 + [event(str(i)) for i in range(40)]
    lands(f"{folder}/landing", "0.json", items)
    lands(f"{folder}/landing", "1.json", items)
    for spread in (1, 16):
        unique = stream_dedup(silver_stream(spark, folder), spread=spread)
        write_updates(unique, f"{folder}/s{spread}", f"{folder}/c{spread}")
        seen = spark.read.schema(SILVER).parquet(f"{folder}/s{spread}")
        assert seen.count() == 41
        assert seen.select("transaction_id").distinct().count() == 41


def test_stream_latest_equals_batch_silver(spark, folder):
    items = many_events(3)
    for n in range(4):
        lands(f"{folder}/landing", f"{n}.json", items[n::4])
    latest = stream_latest(silver_stream(spark, folder))
    write_updates(latest, f"{folder}/silver", f"{folder}/c")
    seen = rows(read_stream_latest(spark, f"{folder}/silver"))
    assert seen == rows(build_silver(bronze(spark, items)))
    assert rows(gold_account_summary(read_stream_latest(spark, f"{folder}/silver"))) == (
        gold_by_hand(items)
    )


def test_stream_resumes_with_its_state(spark, folder):
    for n in range(2):
        lands(f"{folder}/landing", f"{n}.json", [event("a"), event(str(n))])
        seen, _ = daily(spark, folder)
    assert seen == gold_by_hand([event("a"), event("0"), event("1")])


def test_running_update_query(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a")])
    unique = stream_dedup(silver_stream(spark, folder), spread=1)
    query = write_updates(stream_gold(unique), f"{folder}/g", f"{folder}/c", every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert read_stream_gold(spark, f"{folder}/g").agg(F.sum("qty_transactions")).first()[0] == 1

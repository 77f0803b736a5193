import pytest
from helpers import bronze, event, rows
from pyspark.sql import functions as F

from tellerbook.operators.silver import build_silver, flag_high_value, silver_cast
from tellerbook.operators.sketches import BOUND, daily_sketches, stream_sketches, united
from tellerbook.sources.events import accepted, parse_events, read_event_stream, write_events
from tellerbook.sources.adapters import click_events
from tellerbook.streaming.daily import read_stream_sketches, stream_silver, write_updates

def whole():
    return F.lit("all")


def test_days_add_up_to_any_range(spark):
    items = [event(f"t{i}", f"2026-07-{1 + i % 9:02d}T00:00:00", sender_account=f"a{i % 70}") for i in range(700)]
    sketches = daily_sketches(build_silver(bronze(spark, items)))
    assert sketches.count() == 9
    (found,) = united(sketches, whole()).collect()
    assert found.estimate == 70 and found.at_least <= 70 <= found.at_most
    per_day = {r.period: r.estimate for r in united(sketches, F.col("date_transaction").cast("string")).collect()}
    exact = {}
    for i in items:
        exact.setdefault(i["timestamp"][:10], set()).add(i["sender_account"])
    assert per_day == {day: len(ids) for day, ids in exact.items()}


def test_the_bound_holds_for_many_ids(spark):
    rows_ = spark.range(300_000).select(
        F.col("id").cast("string").alias("sender_account"),
        F.timestamp_seconds(F.col("id") % 5 * 86_400).alias("transaction_timestamp"),
    )
    (found,) = united(daily_sketches(rows_.union(rows_)), whole()).collect()
    assert found.at_least <= 300_000 <= found.at_most and found.at_most - found.at_least < 300_000 * BOUND * 2.1


def test_nulls_and_no_rows(spark):
    silver = flag_high_value(silver_cast(bronze(spark, [event("a"), event("b")])))
    silver = silver.withColumn("sender_account", F.lit(None).cast("string"))
    assert united(daily_sketches(silver), whole()).head().estimate == 0
    assert united(daily_sketches(silver.limit(0)), whole()).collect() == []


def test_a_stream_keeps_the_same_sketches(spark, folder):
    events = click_events(spark, "/root/testdata/sf0.001")
    half = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    for part in (events.where(half), events.where(~half), events.where(half)):
        write_events(part, f"{folder}/landing")
        lines = read_event_stream(spark, f"{folder}/landing")
        live = stream_sketches(stream_silver(accepted(parse_events(lines))), watermark="60 days")
        query = write_updates(live, f"{folder}/ids", f"{folder}/checkpoint")
        assert all(o["numRowsTotal"] <= 31 for p in query.recentProgress for o in p["stateOperators"])
    batch = daily_sketches(build_silver(events))
    day = F.col("date_transaction")
    assert rows(united(read_stream_sketches(spark, f"{folder}/ids"), day)) == rows(united(batch, day))


def test_an_exact_count_is_rejected_on_streams(spark, folder):
    write_events(click_events(spark, "/root/testdata/sf0.001"), f"{folder}/landing")
    silver = stream_silver(accepted(parse_events(read_event_stream(spark, f"{folder}/landing"))))
    counted = silver.groupBy("transaction_type").agg(F.countDistinct("sender_account"))
    with pytest.raises(Exception, match="[Dd]istinct"):
        write_updates(counted, f"{folder}/out", f"{folder}/checkpoint")

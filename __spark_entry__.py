"""

``queries()`` maps names to (spark, folder) -> DataFrame; ``oracle_sql()`` holds
the DuckDB twin of each. Every query runs over its whole tables.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import time
import uuid
from collections.abc import Callable
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tellerbook.functions.columns import iso_text, utc_date  # noqa: E402
from tellerbook.operators import quality  # noqa: E402
from tellerbook.operators.drift import (  # noqa: E402
    amount_sketches,
    check_drift,
    read_runs,
    write_run,
)
from tellerbook.operators.gold import gold_account_summary  # noqa: E402
from tellerbook.operators.silver import (  # noqa: E402
    build_silver,
    flag_high_value,
    silver_cast,
)
from tellerbook.operators.sketches import daily_sketches, stream_sketches, united  # noqa: E402
from tellerbook.operators.synth import transactions_for  # noqa: E402
from tellerbook.plans.deltas import fold_changes, refresh_gold_deltas  # noqa: E402
from tellerbook.plans.pipeline import (  # noqa: E402
    read_gold,
    read_silver,
    refresh_gold_dates,
    run_pipeline,
    write_gold,
)
from tellerbook.plans.views import register_views  # noqa: E402
from tellerbook.schemas import EVENT, GOLD, GOLD_KEYS, SILVER  # noqa: E402
from tellerbook.session import ship_package, working_folder  # noqa: E402
from tellerbook.sources.adapters import (  # noqa: E402
    click_events,
    lineitem_events,
    order_events,
    table,
)
from tellerbook.sources.bronze import (  # noqa: E402
    append_bronze,
    ensure_bronze,
    read_bronze,
    read_bronze_as_of,
    read_bronze_table,
    read_quarantine,
    refresh_bronze_table,
)
from tellerbook.sources.clustering import write_clustered  # noqa: E402
from tellerbook.sources.events import (  # noqa: E402
    accepted,
    encode_events,
    parse_events,
    read_event_stream,
    write_events,
)
from tellerbook.sources.fields import promote_field, read_bronze_with_extra  # noqa: E402
from tellerbook.sources.replay import last_arrival, replay  # noqa: E402
from tellerbook.streaming.daily import (  # noqa: E402
    read_stream_gold,
    read_stream_latest,
    read_stream_sketches,
    stream_dedup,
    stream_gold,
    stream_latest,
    stream_silver,
    write_updates,
)
from tellerbook.streaming.ingest import run_ingest  # noqa: E402
from tellerbook.streaming.latest import read_latest_by_time, stream_latest_bounded  # noqa: E402
from tellerbook.streaming.repair import LiveGold, run_live_gold  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The events table has small values; this threshold flags some of them.
CLICK_THRESHOLD = 100.0
GAP = ("2024-01-10", "2024-01-15")
# Folders of the id index.
BUCKETS = 16


def _plain_time(rows: DataFrame) -> DataFrame:
    """Instants as UTC timestamps without zone, as DuckDB holds them."""
    return rows.withColumn(
        "transaction_timestamp", F.col("transaction_timestamp").cast("timestamp_ntz")
    )


# Silver and gold


def q_silver_cast(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_time(silver_cast(lineitem_events(spark, folder)))


def q_silver_high_value(spark: SparkSession, folder: str) -> DataFrame:
    flagged = flag_high_value(silver_cast(order_events(spark, folder)))
    return flagged.select("transaction_id", "amount_usd", "is_high_value")


def q_silver_dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_time(build_silver(lineitem_events(spark, folder)))


def q_silver_unique_input(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_time(build_silver(order_events(spark, folder)))


def q_gold_account_summary(spark: SparkSession, folder: str) -> DataFrame:
    return gold_account_summary(build_silver(lineitem_events(spark, folder)), unique_ids=True)


def q_gold_without_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct count has work to do when ids repeat."""
    return gold_account_summary(flag_high_value(silver_cast(lineitem_events(spark, folder))))


def q_gold_orders(spark: SparkSession, folder: str) -> DataFrame:
    return gold_account_summary(build_silver(order_events(spark, folder)), unique_ids=True)


def q_gold_clicks(spark: SparkSession, folder: str) -> DataFrame:
    silver = build_silver(click_events(spark, folder), CLICK_THRESHOLD)
    return gold_account_summary(silver, unique_ids=True)


def q_sql_over_views(spark: SparkSession, folder: str) -> DataFrame:
    """The layers read from SQL: what each day moved, and through how many receivers."""
    register_views(click_events(spark, folder), CLICK_THRESHOLD)
    return spark.sql("""
        SELECT g.date_transaction, g.qty, g.qty_high, s.receivers
        FROM (SELECT date_transaction, sum(qty_transactions) AS qty,
                     sum(qty_high_level) AS qty_high
              FROM gold_account_summary GROUP BY date_transaction) g
        JOIN (SELECT to_date(transaction_timestamp) AS day,
                     count(DISTINCT receiver_account) AS receivers
              FROM silver_transactions GROUP BY 1) s
        ON g.date_transaction = s.day""")


# Events


def q_events_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = encode_events(click_events(spark, folder))
    return _plain_time(silver_cast(accepted(parse_events(lines))))


def q_events_parse_props(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.from_json("props", "k INT")
    return table(spark, folder, "events").select("event_id", parsed["k"].alias("k"))


def _faulty_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One line per event; each event type but one carries its own fault."""
    kind = F.col("event_type")
    day = F.to_date("ts").cast("string")
    stamp = F.when(kind == "purchase", F.lit("None")).otherwise(day)
    amount = (
        F.when(kind == "click", F.lit(""))
        .when(kind == "signup", F.lit(', "amount": null'))
        .otherwise(F.concat(F.lit(', "amount": "'), F.col("user_id"), F.lit('.5"')))
    )
    end = F.when(kind == "error", F.lit("")).otherwise(F.lit("}"))
    return table(spark, folder, "events").select(
        F.concat(
            F.lit('{"transaction_id": "'), "event_id",
            F.lit('", "timestamp": "'), stamp,
            F.lit('", "sender_account": "'), "user_id",
            F.lit('", "receiver_account": "r'), "user_id",
            F.lit('", "transaction_type": "'), kind, F.lit('"'),
            amount, end,
        ).alias("value")
    )


def q_events_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_events(_faulty_lines(spark, folder))
    return parsed.select("transaction_id", "amount", "value", "reason")


def q_bronze_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines through the log: one write, then the rejected part."""
    root = working_folder(spark, "quarantine")
    append_bronze(parse_events(_faulty_lines(spark, folder)), root, 0)
    return read_quarantine(spark, root).select("value", "reason", "batch_id")


# Bronze


def q_bronze_partition_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "scan")
    append_bronze(lineitem_events(spark, folder), root, 0)
    rows = read_bronze(spark, root).where(F.col("transaction_type") == "R")
    return rows.select("transaction_id", "sender_account", "receiver_account", "amount")


def _two_batches(spark: SparkSession, folder: str) -> str:
    root = working_folder(spark, "batches")
    append_bronze(lineitem_events(spark, folder), root, 0)
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"),
        F.col("o_orderstatus").alias("channel"),
    )
    later = order_events(spark, folder).join(orders, "transaction_id")
    append_bronze(later, root, 1)
    return root


def q_bronze_as_of(spark: SparkSession, folder: str) -> DataFrame:
    root = _two_batches(spark, folder)

    def totals(batch_id: int) -> DataFrame:
        rows = read_bronze_as_of(spark, root, batch_id)
        return rows.groupBy(F.lit(batch_id).alias("as_of"), "transaction_type").agg(
            F.count("*").alias("n"),
            F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total"),
        )

    return totals(0).union(totals(1))


def q_bronze_merge_schema(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_bronze(spark, _two_batches(spark, folder), merge_schema=True)
    return rows.groupBy("batch_id", "channel").agg(F.count("*").alias("n"))


def q_bronze_catalog_table(spark: SparkSession, folder: str) -> DataFrame:
    """The log as a catalog table, declared before its batches are written."""
    root = working_folder(spark, "catalog")
    name = f"default.transactions_raw_{uuid.uuid4().hex}"
    ensure_bronze(spark, root, name)
    append_bronze(click_events(spark, folder), root, 0)
    append_bronze(order_events(spark, folder), root, 1)
    refresh_bronze_table(spark, name)
    return read_bronze_table(spark, name).select("transaction_id", "transaction_type", "amount", "batch_id")


# Quality


def q_dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_events(_faulty_lines(spark, folder))
    return quality.check_not_null(parsed, ["transaction_id", "timestamp", "amount"])


def q_dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    items = quality.check_unique(table(spark, folder, "lineitem"), "l_orderkey")
    return items.union(quality.check_unique(table(spark, folder, "orders"), "o_orderkey"))


def q_dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return quality.check_accepted_values(rows, "event_type", ["click", "view", "purchase"])


def q_dq_expression(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver_cast(lineitem_events(spark, folder))
    differ = F.col("sender_account") != F.col("receiver_account")
    return quality.check_expression(rows, "sender_is_not_receiver", differ)


def q_dq_silver_suite(spark: SparkSession, folder: str) -> DataFrame:
    rows = silver_cast(lineitem_events(spark, folder))
    return quality.run_row_checks(rows, quality.silver_checks())


def q_dq_relationship(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    suppliers = table(spark, folder, "supplier")
    held = quality.check_relationship(items, "l_orderkey", orders, "o_orderkey")
    return held.union(quality.check_relationship(items, "l_partkey", suppliers, "s_suppkey"))


# Pipeline, backfill, refresh


def q_pipeline_gold(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "pipeline")
    append_bronze(click_events(spark, folder), f"{root}/bronze", 0)
    run_pipeline(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/gold", CLICK_THRESHOLD
    )
    return read_gold(spark, f"{root}/gold")


def q_gold_partitioned_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "gold")
    write_gold(q_gold_clicks(spark, folder), root)
    return read_gold(spark, root).where(F.col("date_transaction").between(*GAP))


def q_gold_after_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the gap arrive last, through the same stream."""
    root = working_folder(spark, "backfill")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    silver, gold = f"{root}/silver", f"{root}/gold"
    events = click_events(spark, folder)
    in_gap = F.substring("timestamp", 1, 10).between(*GAP)

    write_events(events.where(~in_gap), landing)
    run_ingest(spark, landing, bronze, f"{root}/checkpoint")
    run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD)

    write_events(events.where(in_gap), landing)
    run_ingest(spark, landing, bronze, f"{root}/checkpoint")
    late = read_bronze(spark, bronze).where(F.col("batch_id") > 0)
    refresh_gold_dates(spark, late, silver, gold, CLICK_THRESHOLD)
    return read_gold(spark, gold)


def _corrections(spark: SparkSession, folder: str) -> DataFrame:
    """A later version of every error event: three days on, twice the value."""
    rows = table(spark, folder, "events").where(F.col("event_type") == "error")
    return rows.select(
        F.col("event_id").cast("string").alias("transaction_id"),
        iso_text(F.col("ts") + F.expr("INTERVAL 3 DAYS")).alias("timestamp"),
        F.col("user_id").cast("string").alias("sender_account"),
        F.col("event_id").cast("string").alias("receiver_account"),
        F.lit("corrected").alias("transaction_type"),
        (F.col("value") * 2).alias("amount"),
    )


def _refreshed(spark: SparkSession, folder: str, buckets: int | None) -> DataFrame:
    root = working_folder(spark, "refresh")
    bronze, silver, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    append_bronze(click_events(spark, folder), bronze, 0)
    run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD, buckets=buckets)
    append_bronze(_corrections(spark, folder), bronze, 1)
    fresh = read_bronze(spark, bronze).where(F.col("batch_id") > 0)
    refresh_gold_dates(spark, fresh, silver, gold, CLICK_THRESHOLD)
    return read_gold(spark, gold)


def q_gold_refresh_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Corrections move ids to other days and types."""
    return _refreshed(spark, folder, None)


def q_gold_refresh_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with the days of the earlier versions looked up in the index."""
    return _refreshed(spark, folder, BUCKETS)


def q_gold_delta_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The same corrections by signed differences; coming again, they change nothing."""
    root = working_folder(spark, "delta")
    bronze, silver, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    append_bronze(click_events(spark, folder), bronze, 0)
    run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD, buckets=BUCKETS)
    append_bronze(_corrections(spark, folder), bronze, 1)
    fresh = read_bronze(spark, bronze).where(F.col("batch_id") > 0)
    refresh_gold_deltas(spark, fresh, silver, gold, CLICK_THRESHOLD)
    if refresh_gold_deltas(spark, fresh, silver, gold, CLICK_THRESHOLD):
        raise AssertionError("a rerun changed something")
    return read_gold(spark, gold)


def q_silver_after_deltas(spark: SparkSession, folder: str) -> DataFrame:
    """Silver itself after a delta refresh whose changes are folded into the day folders."""
    root = working_folder(spark, "fold")
    bronze, silver, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    append_bronze(click_events(spark, folder), bronze, 0)
    run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD, buckets=BUCKETS)
    refresh_gold_deltas(spark, _corrections(spark, folder), silver, gold, CLICK_THRESHOLD)
    fold_changes(spark, silver, gold)
    return _plain_time(read_silver(spark, silver).select(*SILVER.fieldNames()))


def q_gate_closed(spark: SparkSession, folder: str) -> DataFrame:
    """A batch with endless amounts reaches gold neither by refresh nor by rebuild."""
    root = working_folder(spark, "gate")
    bronze, silver, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    events = click_events(spark, folder)
    append_bronze(events, bronze, 0)
    run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD)
    bad = events.withColumn("amount", F.lit(float("inf")))
    own_ids = F.concat(F.lit("bad-"), "transaction_id")
    append_bronze(bad.withColumn("transaction_id", own_ids), bronze, 1)
    fresh = read_bronze(spark, bronze).where(F.col("batch_id") > 0)
    for attempt in (
        lambda: refresh_gold_dates(spark, fresh, silver, gold, CLICK_THRESHOLD),
        lambda: run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD),
    ):
        try:
            attempt()
        except quality.QualityError:
            continue
        raise AssertionError("the gate stayed open")
    return read_gold(spark, gold)


# Streams


def q_stream_ingest_gold(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "ingest")
    write_events(lineitem_events(spark, folder), f"{root}/landing")
    run_ingest(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    silver = build_silver(read_bronze(spark, f"{root}/bronze"))
    return gold_account_summary(silver, unique_ids=True)


def q_stream_paced_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """One file a trigger, so several batches; a pull that finds nothing adds none."""
    root = working_folder(spark, "paced")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    events = order_events(spark, folder)
    for part in range(3):
        write_events(events.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == part), landing)
    batches = []
    for _ in range(2):
        run_ingest(spark, landing, bronze, f"{root}/checkpoint", max_files=1)
        batches.append(read_bronze(spark, bronze).select("batch_id").distinct().count())
    if batches[0] < 3 or batches[1] != batches[0]:
        raise AssertionError(f"batches: {batches}")
    return read_bronze(spark, bronze).select("transaction_id", "sender_account", "transaction_type", "amount")


def _redelivered(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """A stream in which every event is delivered twice."""
    events = click_events(spark, folder)
    write_events(events, f"{root}/landing")
    write_events(events, f"{root}/landing")
    lines = read_event_stream(spark, f"{root}/landing")
    return stream_silver(accepted(parse_events(lines)), CLICK_THRESHOLD)


def q_stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "dedup")
    first = stream_dedup(_redelivered(spark, folder, root))
    write_updates(first, f"{root}/silver", f"{root}/checkpoint")
    written = spark.read.schema(SILVER).parquet(f"{root}/silver")
    return _plain_time(written.select(*SILVER.fieldNames()))


def q_stream_daily_window(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "daily")
    daily = stream_gold(stream_dedup(_redelivered(spark, folder, root)))
    write_updates(daily, f"{root}/gold", f"{root}/checkpoint")
    return read_stream_gold(spark, f"{root}/gold")


def q_stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    root = working_folder(spark, "latest")
    write_events(lineitem_events(spark, folder), f"{root}/landing")
    lines = read_event_stream(spark, f"{root}/landing")
    latest = stream_latest(stream_silver(accepted(parse_events(lines))))
    write_updates(latest, f"{root}/silver", f"{root}/checkpoint")
    return _plain_time(read_stream_latest(spark, f"{root}/silver"))


def q_stream_merged_updates(spark: SparkSession, folder: str) -> DataFrame:
    """Many small batches of daily gold, merged as the stream goes on."""
    root = working_folder(spark, "merged")
    events = click_events(spark, folder)
    for part in range(4):
        write_events(events.where(F.pmod(F.xxhash64("transaction_id"), F.lit(4)) == part), f"{root}/landing")
        lines = read_event_stream(spark, f"{root}/landing")
        rows = stream_dedup(stream_silver(accepted(parse_events(lines)), CLICK_THRESHOLD), watermark="60 days")
        write_updates(stream_gold(rows), f"{root}/gold", f"{root}/checkpoint", keys=GOLD_KEYS, most=3)
    return read_stream_gold(spark, f"{root}/gold")


def _by_time(events: DataFrame, after: str, before: str) -> DataFrame:
    return events.where((F.col("timestamp") >= after) & (F.col("timestamp") < before))


def q_stream_latest_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Events and corrections in three deliveries by time; old ids are forgotten between them."""
    root = working_folder(spark, "bounded")
    events = click_events(spark, folder).union(_corrections(spark, folder))
    for after, before in (("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "9999")):
        write_events(_by_time(events, after, before), f"{root}/landing")
        lines = read_event_stream(spark, f"{root}/landing")
        rows = stream_silver(accepted(parse_events(lines)), CLICK_THRESHOLD)
        write_updates(stream_latest_bounded(rows), f"{root}/silver", f"{root}/checkpoint")
    return _plain_time(read_latest_by_time(spark.read.schema(SILVER).parquet(f"{root}/silver")))


def q_stream_late_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in no order, over several batches; rows behind the frontier repair gold."""
    root = working_folder(spark, "repair")
    events = click_events(spark, folder).union(_corrections(spark, folder))
    third = F.pmod(F.xxhash64("transaction_id", "timestamp"), F.lit(3))
    live = LiveGold(spark, root, threshold=CLICK_THRESHOLD, buckets=BUCKETS)
    for part in (1, 0, 2):
        write_events(events.where(third == part), f"{root}/landing")
        run_live_gold(live, f"{root}/landing")
    live.close_days()
    return read_gold(spark, live.gold)


def q_bronze_promoted_field(spark: SparkSession, folder: str) -> DataFrame:
    """A field that the schema doesn't know becomes a column, over the batches that had it."""
    root = working_folder(spark, "fields")
    events = table(spark, folder, "events").select(F.col("event_id").cast("string").alias("transaction_id"), "props")
    lines = encode_events(click_events(spark, folder).join(events, "transaction_id"))
    # The column is JSON text; here it goes into the message as an object.
    nested = F.regexp_replace(F.replace(F.col("value"), F.lit('\\"'), F.lit('"')), r'"props":"(\{.*\})"', '"props":$1')
    lines.select(nested.alias("value")).write.text(f"{root}/landing")
    run_ingest(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint", keep_unknown=True)
    append_bronze(order_events(spark, folder), f"{root}/bronze", 0)
    rows = promote_field(read_bronze_with_extra(spark, f"{root}/bronze"), "$.props.k", "int", "k")
    return rows.select("transaction_id", "transaction_type", "k")


def q_bronze_replay_window(spark: SparkSession, folder: str) -> DataFrame:
    """Of the second of three deliveries bronze has half; a replay of its window adds the rest."""
    root = working_folder(spark, "replay")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    events = click_events(spark, folder)
    key = F.pmod(F.xxhash64("transaction_id"), F.lit(6))
    window = []
    for first in (0, 2, 4):
        window.append(last_arrival(spark, landing) if first else None)
        time.sleep(0.1)
        write_events(events.where((key == first) | (key == first + 1)), landing)
    append_bronze(events.where(key != 3), bronze, 0)
    after, before = window[1], window[2] + timedelta(milliseconds=1)
    replay(spark, landing, bronze, after, before)
    if replay(spark, landing, bronze, after, before):
        raise AssertionError("a replay was not complete")
    return read_bronze(spark, bronze).select(*EVENT.fieldNames())


def q_gold_zorder_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Gold along a Z curve over account and type, filtered by each of them."""
    root = working_folder(spark, "zorder")
    write_clustered(q_gold_clicks(spark, folder), root, ["account_id", "transaction_type"], files=16)
    gold = spark.read.schema(GOLD).parquet(root)
    return gold.where((F.col("account_id") == "7") | (F.col("transaction_type") == "purchase"))


def q_dq_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of the transactions agree; with doubled amounts they don't."""
    silver = build_silver(lineitem_events(spark, folder))
    odd = F.col("transaction_id").cast("long") % 2 == 1
    root = working_folder(spark, "runs")
    write_run(amount_sketches(silver.where(~odd)), root, 0)
    before = read_runs(spark, root)
    later = silver.where(odd)
    shifted = later.withColumn("amount_usd", F.col("amount_usd") * 2)
    return check_drift(amount_sketches(later), before).union(check_drift(amount_sketches(shifted), before))


def q_gate_closed_by_drift(spark: SparkSession, folder: str) -> DataFrame:
    """A batch whose amounts are tenfold doesn't reach gold."""
    root = working_folder(spark, "drift")
    bronze, silver, gold = f"{root}/bronze", f"{root}/silver", f"{root}/gold"
    events = click_events(spark, folder)
    append_bronze(events, bronze, 0)
    run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD, runs_root=f"{root}/runs")
    own_ids = F.concat(F.lit("later-"), "transaction_id")
    append_bronze(events.withColumn("transaction_id", own_ids).withColumn("amount", F.col("amount") * 10), bronze, 1)
    try:
        run_pipeline(spark, bronze, silver, gold, CLICK_THRESHOLD, runs_root=f"{root}/runs")
    except quality.QualityError:
        return read_gold(spark, gold)
    raise AssertionError("the gate stayed open")


def q_sketch_monthly_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Stored daily sketches united by month, against the exact counts."""
    silver = build_silver(lineitem_events(spark, folder))
    root = working_folder(spark, "sketches")
    daily_sketches(silver).write.parquet(root)
    return _against_exact(spark.read.parquet(root), silver)


def q_stream_monthly_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The same of sketches that a stream keeps, on which copies leave no trace."""
    root = working_folder(spark, "stream-sketches")
    write_updates(stream_sketches(_redelivered(spark, folder, root)), f"{root}/ids", f"{root}/checkpoint")
    silver = build_silver(click_events(spark, folder), CLICK_THRESHOLD)
    return _against_exact(read_stream_sketches(spark, f"{root}/ids"), silver)


def _against_exact(sketches: DataFrame, silver: DataFrame) -> DataFrame:
    def month(day: str | Column) -> Column:
        return F.date_format(day, "yyyy-MM")

    exact = silver.groupBy(month(utc_date(F.col("transaction_timestamp"))).alias("period")).agg(
        F.countDistinct("sender_account").alias("accounts")
    )
    held = F.col("accounts").between(F.col("at_least"), F.col("at_most")).alias("within_bound")
    return united(sketches, month("date_transaction")).join(exact, "period").select("period", "accounts", held)


# Synthesis


def q_synth_backfill(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return transactions_for(orders, "o_orderkey", "2026-07-07", 6, seed=7)


def q_synth_live(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return transactions_for(events, "event_id", "2026-07-07", 1, seed=7, outlier_rate=0.01)


_QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): function
    for name, function in list(globals().items())
    if name.startswith("q_")
}


def _in_utc(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, folder)

    return run


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the training-data operators, where these are installed."""
    there = importlib.util.find_spec
    if there("tellerbook.llm") is None or there("tellerbook.llm.queries") is None:
        return {}, {}
    from tellerbook.llm.queries import llm_oracle_sql, llm_queries

    found, twins = llm_queries(), llm_oracle_sql()
    if there("corpus_pipeline") is not None:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, twins


def queries() -> dict[str, Query]:
    """One entry per operator; each callable takes (spark, folder)."""
    training = {name: _shipped(query) for name, query in _training_data()[0].items()}
    return {name: _in_utc(query) for name, query in (_QUERIES | training).items()}


def entry(spark: SparkSession) -> DataFrame:
    """Daily account metrics over de-duplicated transactions."""
    return queries()["gold_account_summary"](spark, "/root/testdata/sf0.001")


# Oracles

_LINEITEM = """
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
         CAST(l_suppkey AS VARCHAR) AS sender_account,
         CAST(l_partkey AS VARCHAR) AS receiver_account,
         l_returnflag AS transaction_type,
         l_shipdate AS transaction_timestamp,
         l_extendedprice AS amount_usd
  FROM lineitem"""

_ORDERS = """
  SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
         CAST(o_custkey AS VARCHAR) AS sender_account,
         CAST(o_orderkey AS VARCHAR) AS receiver_account,
         o_orderpriority AS transaction_type,
         o_orderdate AS transaction_timestamp,
         o_totalprice AS amount_usd
  FROM orders"""

_CLICKS = """
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) AS sender_account,
         CAST(event_id AS VARCHAR) AS receiver_account,
         event_type AS transaction_type,
         ts AS transaction_timestamp,
         value AS amount_usd
  FROM events"""

_CORRECTIONS = """
  SELECT CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR),
         'corrected', ts + INTERVAL 3 DAY, value * 2
  FROM events WHERE event_type = 'error'"""


def _flag_sql(rows: str, threshold: float = 10_000) -> str:
    return f"SELECT *, amount_usd > {threshold} AS is_high_value FROM ({rows})"


def _silver_sql(rows: str, threshold: float = 10_000) -> str:
    return f"""{_flag_sql(rows, threshold)}
  QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY transaction_timestamp DESC NULLS LAST, sender_account DESC NULLS LAST,
      receiver_account DESC NULLS LAST, transaction_type DESC NULLS LAST,
      amount_usd DESC NULLS LAST) = 1"""


def _gold_sql(silver: str) -> str:
    return f"""
SELECT CAST(transaction_timestamp AS DATE) AS date_transaction,
       sender_account AS account_id,
       transaction_type,
       count(DISTINCT transaction_id) AS qty_transactions,
       CAST(sum(CAST(amount_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_value_usd,
       CAST(count_if(is_high_value) AS BIGINT) AS qty_high_level,
       CAST(sum(CASE WHEN is_high_value THEN CAST(amount_usd AS DECIMAL(18,2)) ELSE 0 END)
            AS DOUBLE) AS value_high_level
FROM ({silver})
GROUP BY 1, 2, 3"""


def _monthly_sql(silver: str) -> str:
    return f"""
SELECT strftime(transaction_timestamp, '%Y-%m') AS period, count(DISTINCT sender_account) AS accounts,
       true AS within_bound
FROM ({silver}) GROUP BY 1"""


_CLICK_SILVER = _silver_sql(_CLICKS, 100)
_CLICK_GOLD = _gold_sql(_CLICK_SILVER)
_CORRECTED_SILVER = _silver_sql(f"{_CLICKS} UNION ALL {_CORRECTIONS}", 100)

# The faulty lines, and what becomes of each.
_FAULTY = """
  SELECT event_type,
         '{"transaction_id": "' || event_id
         || '", "timestamp": "'
         || CASE WHEN event_type = 'purchase' THEN 'None' ELSE strftime(ts, '%Y-%m-%d') END
         || '", "sender_account": "' || user_id
         || '", "receiver_account": "r' || user_id
         || '", "transaction_type": "' || event_type || '"'
         || CASE event_type WHEN 'click' THEN ''
                            WHEN 'signup' THEN ', "amount": null'
                            ELSE ', "amount": "' || user_id || '.5"' END
         || CASE WHEN event_type = 'error' THEN '' ELSE '}' END AS line,
         CASE event_type WHEN 'error' THEN 'malformed'
                         WHEN 'signup' THEN 'bad amount'
                         WHEN 'purchase' THEN 'bad timestamp' END AS reason,
         event_id, user_id
  FROM events"""


def _checks_sql(*lines: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{level}' AS level, "
        f"CAST({count} AS BIGINT) AS failing_rows FROM {rows}"
        for check, level, count, rows in lines
    )


def _row_check_sql(rows: str, *checks: tuple[str, str, str]) -> str:
    return _checks_sql(*[(c, lv, f"count_if({fails})", f"({rows})") for c, lv, fails in checks])


def _draw_sql(field: int, size: int) -> str:
    return f"(CAST('0x' || substr(h, {33 + 12 * field}, 12) AS BIGINT) % {size})"


def _synth_sql(rows: str, key: str, days: int, zone: str, types: str, cents: str) -> str:
    accounts = 900 * 90_000
    account = "CAST({0} // 90000 + 100 AS VARCHAR) || '-' || CAST({0} % 90000 + 10000 AS VARCHAR)"
    sender = _draw_sql(2, accounts)
    receiver = f"(({sender} + 1 + {_draw_sql(3, accounts - 1)}) % {accounts})"
    kinds = types.count(",") + 1
    return f"""
WITH hashed AS (
  SELECT sha256('7:' || {key} || ':a') || sha256('7:' || {key} || ':b') AS h FROM {rows})
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-'
         || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')
         || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS transaction_id,
       strftime(TIMESTAMP '2026-07-07' + to_days(CAST({_draw_sql(0, days)} AS INTEGER))
         + to_seconds({_draw_sql(1, 86_400)}), '%Y-%m-%dT%H:%M:%S') || '{zone}' AS "timestamp",
       {account.format(sender)} AS sender_account,
       {account.format(receiver)} AS receiver_account,
       ([{types}])[{_draw_sql(4, kinds)} + 1] AS transaction_type,
       {cents} / 100.0::DOUBLE AS amount
FROM hashed"""


def oracle_sql() -> dict[str, str]:
    """The DuckDB twin of each query."""
    own = {
        "silver_cast": _LINEITEM,
        "silver_high_value": (
            f"SELECT transaction_id, amount_usd, is_high_value FROM ({_flag_sql(_ORDERS)})"
        ),
        "silver_dedup_latest": _silver_sql(_LINEITEM),
        "silver_unique_input": _flag_sql(_ORDERS),
        "gold_account_summary": _gold_sql(_silver_sql(_LINEITEM)),
        "gold_without_dedup": _gold_sql(_flag_sql(_LINEITEM)),
        "gold_orders": _gold_sql(_flag_sql(_ORDERS)),
        "gold_clicks": _CLICK_GOLD,
        "sql_over_views": f"""
SELECT CAST(ts AS DATE) AS date_transaction, count(*) AS qty,
       CAST(count_if(value > 100) AS BIGINT) AS qty_high,
       count(DISTINCT event_id) AS receivers
FROM events GROUP BY 1""",
        "events_roundtrip": _CLICKS,
        "events_parse_props": (
            "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
        ),
        "events_quarantine": f"""
SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS transaction_id,
       CASE event_type WHEN 'click' THEN 0.0 WHEN 'view' THEN user_id + 0.5
                       WHEN 'purchase' THEN user_id + 0.5 END::DOUBLE AS amount,
       CASE WHEN reason IS NOT NULL THEN line END AS "value",
       reason
FROM ({_FAULTY})""",
        "bronze_quarantine": f"""
SELECT line AS "value", reason, CAST(0 AS BIGINT) AS batch_id
FROM ({_FAULTY}) WHERE reason IS NOT NULL""",
        "bronze_partition_scan": f"""
SELECT transaction_id, sender_account, receiver_account, amount_usd AS amount
FROM ({_LINEITEM}) WHERE transaction_type = 'R'""",
        "bronze_as_of": f"""
WITH log AS (SELECT 0 AS batch_id, * FROM ({_LINEITEM})
             UNION ALL SELECT 1, * FROM ({_ORDERS}))
SELECT as_of, transaction_type, count(*) AS n,
       CAST(sum(CAST(amount_usd AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM log JOIN (VALUES (0), (1)) v(as_of) ON batch_id <= as_of
GROUP BY 1, 2""",
        "bronze_catalog_table": f"""
SELECT transaction_id, transaction_type, amount_usd AS amount, CAST(0 AS BIGINT) AS batch_id FROM ({_CLICKS})
UNION ALL SELECT transaction_id, transaction_type, amount_usd, 1 FROM ({_ORDERS})""",
        "stream_paced_ingest": f"""
SELECT transaction_id, sender_account, transaction_type, amount_usd AS amount FROM ({_ORDERS})""",
        "bronze_merge_schema": """
SELECT CAST(0 AS BIGINT) AS batch_id, CAST(NULL AS VARCHAR) AS channel, count(*) AS n
FROM lineitem
UNION ALL SELECT 1, o_orderstatus, count(*) FROM orders GROUP BY o_orderstatus""",
        "dq_not_null": _row_check_sql(
            _FAULTY,
            ("not_null:transaction_id", "error", "event_type = 'error'"),
            ("not_null:timestamp", "error", "event_type = 'error'"),
            ("not_null:amount", "error", "event_type IN ('error', 'signup')"),
        ),
        "dq_unique": _checks_sql(
            (
                "unique:l_orderkey",
                "error",
                "count(*)",
                "(SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)",
            ),
            (
                "unique:o_orderkey",
                "error",
                "count(*)",
                "(SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)",
            ),
        ),
        "dq_accepted_values": _row_check_sql(
            "SELECT * FROM events",
            (
                "accepted_values:event_type",
                "warn",
                "event_type NOT IN ('click', 'view', 'purchase')",
            ),
        ),
        "dq_expression": _row_check_sql(
            _LINEITEM,
            ("expression:sender_is_not_receiver", "warn", "sender_account = receiver_account"),
        ),
        "dq_silver_suite": _row_check_sql(
            _LINEITEM,
            ("not_null:transaction_id", "error", "transaction_id IS NULL"),
            ("not_null:transaction_timestamp", "error", "transaction_timestamp IS NULL"),
            ("not_null:sender_account", "error", "sender_account IS NULL"),
            ("not_null:transaction_type", "error", "transaction_type IS NULL"),
            (
                "accepted_values:transaction_type",
                "warn",
                "transaction_type NOT IN ('PIX', 'TED', 'CREDIT_CARD', 'DEBIT')",
            ),
            ("expression:amount_not_negative", "warn", "amount_usd < 0"),
            ("expression:amount_finite", "error", "NOT isfinite(amount_usd)"),
            (
                "expression:sender_format",
                "warn",
                r"NOT regexp_matches(sender_account, '^\d{3}-\d{5}$')",
            ),
            (
                "expression:receiver_format",
                "warn",
                r"NOT regexp_matches(receiver_account, '^\d{3}-\d{5}$')",
            ),
            ("expression:sender_is_not_receiver", "warn", "sender_account = receiver_account"),
        ),
        "dq_relationship": _checks_sql(
            (
                "relationship:l_orderkey",
                "error",
                "count(*)",
                "lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)",
            ),
            (
                "relationship:l_partkey",
                "error",
                "count(*)",
                "lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)",
            ),
        ),
        "pipeline_gold": _CLICK_GOLD,
        "gold_partitioned_scan": f"""
SELECT * FROM ({_CLICK_GOLD})
WHERE date_transaction BETWEEN DATE '{GAP[0]}' AND DATE '{GAP[1]}'""",
        "gold_after_backfill": _CLICK_GOLD,
        "gate_closed": _CLICK_GOLD,
        "gold_refresh_dates": _gold_sql(_CORRECTED_SILVER),
        "gold_refresh_indexed": _gold_sql(_CORRECTED_SILVER),
        "gold_delta_refresh": _gold_sql(_CORRECTED_SILVER),
        "silver_after_deltas": _CORRECTED_SILVER,
        "stream_ingest_gold": _gold_sql(_silver_sql(_LINEITEM)),
        "stream_dedup": _CLICK_SILVER,
        "stream_daily_window": _CLICK_GOLD,
        "stream_latest": _silver_sql(_LINEITEM),
        "stream_latest_bounded": _CORRECTED_SILVER,
        "stream_late_repair": _gold_sql(_CORRECTED_SILVER),
        "bronze_promoted_field": """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, event_type AS transaction_type,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, NULL FROM orders""",
        "bronze_replay_window": """
SELECT CAST(event_id AS VARCHAR) AS transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE
         WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE '.' || rtrim(strftime(ts, '%f'), '0') END AS "timestamp",
       CAST(user_id AS VARCHAR) AS sender_account, CAST(event_id AS VARCHAR) AS receiver_account,
       event_type AS transaction_type, value AS amount
FROM events""",
        "gold_zorder_scan": f"""
SELECT * FROM ({_CLICK_GOLD}) WHERE account_id = '7' OR transaction_type = 'purchase'""",
        "dq_drift": _checks_sql(
            ("drift:amount_usd", "error", "0", "(SELECT 1)"),
            (
                "drift:amount_usd",
                "error",
                "count(*)",
                f"({_silver_sql(_LINEITEM)}) WHERE CAST(transaction_id AS BIGINT) % 2 = 1",
            ),
        ),
        "gate_closed_by_drift": _CLICK_GOLD,
        "stream_merged_updates": _CLICK_GOLD,
        "sketch_monthly_ids": _monthly_sql(_silver_sql(_LINEITEM)),
        "stream_monthly_ids": _monthly_sql(_CLICK_SILVER),
        "synth_backfill": _synth_sql(
            "orders", "o_orderkey", 6, "", "'PIX', 'TED', 'CREDIT_CARD', 'DEBIT'",
            f"(1000 + {_draw_sql(5, 1_499_001)})",
        ),
        "synth_live": _synth_sql(
            "events", "event_id", 1, "+00:00", "'PIX', 'CREDIT_CARD', 'TED'",
            f"CASE WHEN {_draw_sql(6, 1_000_000)} < 10000 "
            f"THEN 5000000 + {_draw_sql(5, 5_000_001)} ELSE 500 + {_draw_sql(5, 199_501)} END",
        ),
    }
    return own | _training_data()[1]

import json
import os
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from helpers import event, event_rows, gold_by_hand, lands, parsed, rows, without
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from test_silver_gold import many_events

from tellerbook.operators.gold import gold_account_summary
from tellerbook.operators.silver import build_silver
from tellerbook.schemas import EVENT
from tellerbook.sources.bronze import (
    append_bronze,
    ensure_bronze,
    read_bronze,
    read_bronze_as_of,
    read_bronze_table,
    read_quarantine,
    refresh_bronze_table,
)
from tellerbook.streaming.ingest import run_ingest

FIELDS = EVENT.fieldNames()


def stored(spark, root):
    return rows(read_bronze(spark, root).select(*FIELDS))


def ingest(spark, folder, checkpoint="c", **options):
    return run_ingest(
        spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/{checkpoint}", **options
    )


def test_append_and_read_back(spark, folder):
    items = [event("a"), event("b", transaction_type="007"), event("c", transaction_type="TED")]
    append_bronze(event_rows(spark, items), f"{folder}/b", 0)
    assert stored(spark, f"{folder}/b") == rows(event_rows(spark, items))


def test_empty_log_has_the_schema(spark, folder):
    ensure_bronze(spark, f"{folder}/b")
    assert stored(spark, f"{folder}/b") == []
    silver = build_silver(read_bronze(spark, f"{folder}/b"))
    assert gold_account_summary(silver).count() == 0
    assert read_quarantine(spark, f"{folder}/b").count() == 0


def test_empty_batch(spark, folder):
    append_bronze(event_rows(spark, [event("a")]), f"{folder}/b", 0)
    append_bronze(spark.createDataFrame([], EVENT), f"{folder}/b", 1)
    assert len(stored(spark, f"{folder}/b")) == 1


def test_repeated_batch_replaces_itself(spark, folder):
    frame = event_rows(spark, [event("a"), event("b", transaction_type="TED")])
    for _ in range(2):
        append_bronze(frame, f"{folder}/b", 0)
    append_bronze(frame.where("transaction_id = 'b'"), f"{folder}/b", 0)
    assert [r[0] for r in stored(spark, f"{folder}/b")] == ["b"]


def test_one_write_splits_accepted_and_rejected(spark, folder):
    items = [event("a"), "junk", event("b", amount=None), without(event("c"), "timestamp")]
    append_bronze(parsed(spark, items), f"{folder}/b", 3)
    assert [r[0] for r in stored(spark, f"{folder}/b")] == ["a"]
    rejected = read_quarantine(spark, f"{folder}/b")
    assert {r.reason for r in rejected.collect()} == {
        "malformed",
        "bad amount",
        "missing timestamp",
    }
    assert {r.batch_id for r in rejected.collect()} == {3}
    assert "junk" in {r.value for r in rejected.collect()}


def test_type_filter_prunes_folders(spark, folder):
    items = [event("a"), event("b", transaction_type="TED")]
    append_bronze(event_rows(spark, items), f"{folder}/b", 0)
    scan = read_bronze(spark, f"{folder}/b").where("transaction_type = 'TED'")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "transaction_type" in filters and "outcome" in filters
    assert len(scan.inputFiles()) >= 1 and scan.count() == 1


def test_as_of_batch_and_instant(spark, folder):
    root = f"{folder}/b"
    early = datetime(2026, 1, 1, tzinfo=UTC)
    for n in range(3):
        frame = event_rows(spark, [event(str(n))])
        moment = F.lit(early + timedelta(days=n)).cast("timestamp")
        append_bronze(frame.withColumn("ingested_at", moment), root, n)
    assert read_bronze_as_of(spark, root, 1).count() == 2
    assert read_bronze_as_of(spark, root, 0).first().transaction_id == "0"
    assert read_bronze_as_of(spark, root, instant=early + timedelta(days=1)).count() == 2
    assert read_bronze_as_of(spark, root).count() == 3


def test_added_columns(spark, folder):
    root = f"{folder}/b"
    append_bronze(event_rows(spark, [event("a", transaction_type="007")]), root, 0)
    wider = event_rows(spark, [event("b", transaction_type="007")])
    append_bronze(wider.withColumn("channel", F.lit("app")), root, 1)
    for frame in (
        read_bronze(spark, root, merge_schema=True),
        read_bronze(spark, root, added=StructType().add("channel", StringType())),
    ):
        seen = {(r.transaction_id, r.transaction_type, r.channel) for r in frame.collect()}
        assert seen == {("a", "007", None), ("b", "007", "app")}
    assert "channel" not in read_bronze(spark, root).columns


def test_table_over_the_log(spark, folder):
    table = "teller_test.transactions_raw"
    try:
        for n in range(2):
            ensure_bronze(spark, f"{folder}/b", table)
            append_bronze(parsed(spark, [event(str(n)), "junk"]), f"{folder}/b", n)
            refresh_bronze_table(spark, table)
        frame = read_bronze_table(spark, table)
        assert rows(frame) == rows(read_bronze(spark, f"{folder}/b"))
        assert frame.count() == 2
        assert spark.table(table).where("outcome = 'quarantined'").count() == 2
    finally:
        spark.sql("DROP DATABASE IF EXISTS teller_test CASCADE")


def test_another_file_format(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a"), "junk"])
    ingest(spark, folder, file_format="orc")
    root = f"{folder}/bronze"
    wider = event_rows(spark, [event("b")]).withColumn("channel", F.lit("app"))
    append_bronze(wider, root, 0, file_format="orc")
    frame = read_bronze(spark, root, merge_schema=True, file_format="orc")
    assert {(r.transaction_id, r.channel) for r in frame.collect()} == {("a", None), ("b", "app")}
    assert read_bronze_as_of(spark, root, 0, file_format="orc").count() == 2
    assert read_quarantine(spark, root, file_format="orc").count() == 1


def test_rebalance_keeps_rows(spark, folder):
    items = [event(str(i), transaction_type=t) for i, t in enumerate(["PIX", "TED"] * 20)]
    frame = event_rows(spark, items).repartition(8)
    append_bronze(frame, f"{folder}/even", 0, rebalance=True)
    append_bronze(frame, f"{folder}/plain", 0)
    assert stored(spark, f"{folder}/even") == stored(spark, f"{folder}/plain")
    even = read_bronze(spark, f"{folder}/even").inputFiles()
    assert len(even) < len(read_bronze(spark, f"{folder}/plain").inputFiles())


def test_stream_equals_batch_whatever_the_file_order(spark, folder):
    items = many_events(11)
    for n in range(6):
        lands(f"{folder}/landing", f"{n}.json", items[n::6])
    ingest(spark, folder, max_files=2)
    log = read_bronze(spark, f"{folder}/bronze")
    assert log.select("batch_id").distinct().count() == 3
    assert log.count() == len(items)
    assert rows(gold_account_summary(build_silver(log))) == gold_by_hand(items)


def test_poison_lines_do_not_stop_the_stream(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a"), "junk", event("b", amount=None)])
    lands(f"{folder}/landing", "1.json", [event("c")])
    ingest(spark, folder, max_files=1)
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["a", "c"]
    assert read_quarantine(spark, f"{folder}/bronze").count() == 2


def test_resume_takes_only_new_files(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a")])
    ingest(spark, folder)
    ingest(spark, folder)
    lands(f"{folder}/landing", "1.json", [event("b")])
    ingest(spark, folder)
    log = read_bronze(spark, f"{folder}/bronze")
    seen = sorted((r.batch_id, r.transaction_id) for r in log.collect())
    assert seen == [(0, "a"), (1, "b")]


def test_files_that_keep_an_old_date_are_taken(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a")])
    ingest(spark, folder)
    lands(f"{folder}/landing", "1.json", [event("b")], days_old=60)
    ingest(spark, folder)
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["a", "b"]


def test_crash_between_write_and_commit_repeats_the_batch(spark, folder, tmp_path):
    for n in range(3):
        lands(f"{folder}/landing", f"{n}.json", [event(str(n)), event(f"{n}x")])
    ingest(spark, folder, max_files=1)
    before = rows(read_bronze(spark, f"{folder}/bronze"))
    # As if the last batch had been written but its commit had not.
    for file in (tmp_path / "c" / "commits").iterdir():
        if file.name.lstrip(".").startswith("2"):
            file.unlink()
    ingest(spark, folder, max_files=1)
    assert rows(read_bronze(spark, f"{folder}/bronze")) == before


def test_failed_batch_is_taken_again(spark, folder, monkeypatch):
    import tellerbook.streaming.ingest as module

    lands(f"{folder}/landing", "0.json", [event("a")])
    lands(f"{folder}/landing", "1.json", [event("b")])
    write = module.append_bronze

    def fail_on_second(batch, root, batch_id, *rest):
        write(batch, root, batch_id, *rest)
        if batch_id == 1:
            raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(module, "append_bronze", fail_on_second)
        with pytest.raises(Exception, match="lost"):
            ingest(spark, folder, max_files=1)
    ingest(spark, folder, max_files=1)
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["a", "b"]


def test_fresh_checkpoint_adds_beside_the_old_batches(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a"), event("b")])
    ingest(spark, folder, "first")
    lands(f"{folder}/landing", "1.json", [event("c")])
    ingest(spark, folder, "second")
    log = read_bronze(spark, f"{folder}/bronze")
    assert log.count() == 5
    assert build_silver(log).count() == 3
    ids = {json.loads(Path(folder, c, "metadata").read_text())["id"] for c in ("first", "second")}
    assert {r.ingest for r in log.collect()} == ids


def test_a_new_checkpoint_at_an_old_path_overwrites_nothing(spark, folder):
    lands(f"{folder}/landing", "0.json", [event(str(i)) for i in range(5)])
    ingest(spark, folder)
    Path(folder, "c").rename(Path(folder, "lost"))
    Path(folder, "landing", "0.json").rename(Path(folder, "expired.json"))
    lands(f"{folder}/landing", "1.json", [event("new")])
    ingest(spark, folder)
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["0", "1", "2", "3", "4", "new"]


def test_a_file_of_any_age_arrives(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a")])
    ingest(spark, folder)
    lands(f"{folder}/landing", "1.json", [event("b")])
    os.utime(Path(folder, "landing", "1.json"), (1_000, 1_000))
    ingest(spark, folder)
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["a", "b"]


def test_missing_text_mode(spark, folder):
    lands(f"{folder}/landing", "0.json", [without(event(), "transaction_id"), event("b")])
    ingest(spark, folder, missing_text="None")
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["None", "b"]


def test_running_query_picks_up_files_and_bytes_limit(spark, folder):
    lands(f"{folder}/landing", "0.json", [event("a")])
    query = ingest(spark, folder, every="1 second", max_bytes=10_000_000)
    try:
        query.processAllAvailable()
        lands(f"{folder}/landing", "1.json", [event("b")])
        query.processAllAvailable()
    finally:
        query.stop()
    assert [r[0] for r in stored(spark, f"{folder}/bronze")] == ["a", "b"]

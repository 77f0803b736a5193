import pytest
from helpers import event, lands, lines, parsed, rows
from pyspark.sql import functions as F

from tellerbook.sources.bronze import read_bronze
from tellerbook.sources.events import accepted, parse_events
from tellerbook.sources.fields import promote_field, read_bronze_with_extra, unknown_fields
from tellerbook.streaming.ingest import run_ingest


def extras(spark, items):
    frame = parsed(spark, items, keep_unknown=True)
    return [r[0] for r in frame.orderBy("transaction_id").select(F.col("extra").cast("string")).collect()]


def test_only_unknown_fields_are_kept(spark):
    items = [
        event("a"),
        event("b", device={"os": "x", "v": [1, 2]}, note=None),
        event("c", amount="no", device=1),
        event("d", Amount=5),
    ]
    assert extras(spark, items) == [None, '{"device":{"os":"x","v":[1,2]},"note":null}', None, '{"Amount":5}']


def test_lines_that_are_rejected_keep_nothing(spark):
    broken = ['{"transaction_id": "a", "device": 1', "[1]", "not json"]
    assert extras(spark, broken) == [None] * 3


def test_a_field_named_twice_gives_no_variant_but_keeps_the_row(spark):
    line = '{"transaction_id":"a","timestamp":"2026-07-07","sender_account":"s","receiver_account":"r","transaction_type":"PIX","x":1,"x":2}'
    found = parse_events(lines(spark, [line]), keep_unknown=True).head()
    assert found.reason is None and found.extra is None


def test_the_other_columns_do_not_depend_on_it(spark):
    items = [event("a", x=1), event("b", amount=None), "nonsense", event("c")]
    plain = parsed(spark, items)
    kept = parsed(spark, items, keep_unknown=True)
    assert rows(kept.drop("extra")) == rows(plain) and "extra" not in plain.columns
    assert accepted(kept).columns[-1] == "extra"


@pytest.fixture
def bronze_root(spark, folder):
    """A batch without the column, one with unknown fields, one with other ones."""
    landing, root = f"{folder}/landing", f"{folder}/bronze"
    lands(landing, "1.json", [event("a", device={"os": "lost"})])
    run_ingest(spark, landing, root, f"{folder}/c")
    lands(landing, "2.json", [event("b", device={"os": "linux", "cores": 8}), event("c")])
    run_ingest(spark, landing, root, f"{folder}/c", keep_unknown=True)
    lands(landing, "3.json", [event("d", device={"os": 7}, vip=True), event("e", device={"cores": "many"})])
    run_ingest(spark, landing, root, f"{folder}/c", keep_unknown=True)
    return root


def test_promotion_over_old_batches(spark, bronze_root):
    log = read_bronze_with_extra(spark, bronze_root)
    wide = promote_field(promote_field(log, "$.device.os", "string", "os"), "$.device.cores", "int", "cores")
    found = rows(wide.select("transaction_id", "os", "cores"))
    assert found == [("a", None, None), ("b", "linux", 8), ("c", None, None), ("d", "7", None), ("e", None, None)]
    with pytest.raises(ValueError, match="os"):
        promote_field(wide, "$.x", "string", "os")


def test_unknown_fields_are_listed(spark, bronze_root):
    found = unknown_fields(read_bronze_with_extra(spark, bronze_root)).head()
    assert found.rows == 3
    assert found.fields == "OBJECT<device: OBJECT<cores: VARIANT, os: VARIANT>, vip: BOOLEAN>"


def test_bronze_without_the_column_reads_as_before(spark, bronze_root):
    assert sorted(r.transaction_id for r in read_bronze(spark, bronze_root).collect()) == list("abcde")
    assert "extra" not in read_bronze(spark, bronze_root).columns

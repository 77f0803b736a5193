import json
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tellerbook.operators.synth import synthesize_transactions, transactions_for
from tellerbook.schemas import ACCOUNT_PATTERN, EVENT
from tellerbook.sources.events import parse_events, read_events, write_events

UUID4 = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


@pytest.fixture(scope="module")
def outage(spark):
    return synthesize_transactions(spark, seed=3).cache()


def test_shape(spark, outage):
    assert outage.schema.simpleString() == EVENT.simpleString()
    assert outage.count() == 3000
    assert outage.select("transaction_id").distinct().count() == 3000
    for row in outage.limit(200).collect():
        assert re.match(UUID4, row.transaction_id)
        assert re.match(ACCOUNT_PATTERN, row.sender_account)
        assert re.match(ACCOUNT_PATTERN, row.receiver_account)
        assert re.match(r"^2026-07-(0[7-9]|1[0-2])T\d\d:\d\d:\d\d$", row.timestamp)


def test_ranges(outage):
    low, high, same = outage.agg(
        F.min("amount"), F.max("amount"),
        F.count_if(F.col("sender_account") == F.col("receiver_account")),
    ).first()
    assert 10 <= low < 100 and 14_900 < high <= 15_000 and same == 0
    types = {r[0]: r[1] for r in outage.groupBy("transaction_type").count().collect()}
    assert set(types) == {"PIX", "TED", "CREDIT_CARD", "DEBIT"}
    assert min(types.values()) > 600
    days = [r[0] for r in outage.groupBy(F.substring("timestamp", 1, 10)).count().collect()]
    assert len(days) == 6
    assert 800 < outage.where("amount > 10000").count() < 1200


def test_rows_do_not_depend_on_partitions(spark):
    def made(parts):
        return rows(transactions_for(spark.range(0, 300, 1, parts), "id", "2026-07-07", 6, 5))

    assert made(1) == made(8)
    other = rows(transactions_for(spark.range(300), "id", "2026-07-07", 6, 6))
    assert not set(made(1)) & set(other)


def test_live_shape(spark):
    live = synthesize_transactions(spark, 20_000, days=1, seed=1, outlier_rate=0.01)
    low = live.where("amount <= 2000 AND amount >= 5").count()
    high = live.where("amount BETWEEN 50000 AND 100000").count()
    assert low + high == 20_000
    assert 120 < high < 280
    assert {r[0] for r in live.select("transaction_type").distinct().collect()} == {
        "PIX",
        "CREDIT_CARD",
        "TED",
    }
    assert live.first().timestamp.endswith("+00:00")


def test_made_events_are_accepted(spark, folder, outage):
    write_events(outage, f"{folder}/landing")
    lines = read_events(spark, f"{folder}/landing")
    assert set(json.loads(lines.first().value)) == set(EVENT.fieldNames())
    assert rows(parse_events(lines).select(*EVENT.fieldNames())) == rows(outage)


def test_amounts_have_two_decimals(outage):
    assert outage.where("round(amount, 2) <> amount").count() == 0

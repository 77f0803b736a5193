from helpers import event, event_rows, gold_by_hand, rows
from test_silver_gold import many_events

from tellerbook.plans.views import register_views
from tellerbook.sources.bronze import append_bronze, read_bronze


def test_views_follow_the_bronze_they_read(spark, folder):
    items = many_events(2, 80)
    append_bronze(event_rows(spark, items), f"{folder}/b", 0)
    register_views(read_bronze(spark, f"{folder}/b"))
    assert rows(spark.table("gold_account_summary")) == gold_by_hand(items)
    ids = spark.sql("SELECT count(*), count(DISTINCT transaction_id) FROM silver_transactions")
    assert ids.first()[0] == ids.first()[1]


def test_threshold_of_the_views(spark):
    register_views(event_rows(spark, [event(amount=50.0)]), threshold=10)
    assert spark.table("silver_transactions").first().is_high_value

"""Silver and gold as views, evaluated when they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tellerbook.operators.gold import gold_account_summary
from tellerbook.operators.silver import build_silver
from tellerbook.schemas import HIGH_VALUE_THRESHOLD

BRONZE_VIEW = "bronze_transactions"
SILVER_VIEW = "silver_transactions"
GOLD_VIEW = "gold_account_summary"


def register_views(bronze: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> None:
    """Make the three layers readable from SQL in the session of ``bronze``."""
    silver = build_silver(bronze, threshold)
    bronze.createOrReplaceTempView(BRONZE_VIEW)
    silver.createOrReplaceTempView(SILVER_VIEW)
    gold_account_summary(silver, unique_ids=True).createOrReplaceTempView(GOLD_VIEW)

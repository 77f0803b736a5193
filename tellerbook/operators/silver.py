"""Silver: typed columns, the high-value flag, one row per transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerbook.functions.columns import exceeds, utc_instant
from tellerbook.schemas import HIGH_VALUE_THRESHOLD, KEY


def silver_cast(bronze: DataFrame) -> DataFrame:
    """Keyed rows with cast and renamed columns."""
    return bronze.where(F.col(KEY).isNotNull()).select(
        F.col(KEY).cast("string").alias(KEY),
        F.col("sender_account").cast("string").alias("sender_account"),
        F.col("receiver_account").cast("string").alias("receiver_account"),
        F.col("transaction_type").cast("string").alias("transaction_type"),
        utc_instant(F.col("timestamp").cast("string")).alias("transaction_timestamp"),
        F.col("amount").cast("double").alias("amount_usd"),
    )


def flag_high_value(rows: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Add ``is_high_value``; never NULL."""
    return rows.withColumn("is_high_value", exceeds(F.col("amount_usd"), threshold))


def dedup_latest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of each key.

    Ties on ``order`` are settled by every other column, so the kept row does
    not depend on partitioning. Spark limits each key to one row per task
    before the shuffle, so a key with very many copies stays cheap.
    """
    ties = [c for c in rows.columns if c != key and c not in order]
    latest_first = Window.partitionBy(key).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*order, *ties]]
    )
    return (
        rows.withColumn("_version", F.row_number().over(latest_first))
        .where(F.col("_version") == 1)
        .drop("_version")
    )


def build_silver(bronze: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Bronze rows to silver. One shuffle, on the transaction id."""
    latest = dedup_latest(silver_cast(bronze), KEY, ["transaction_timestamp"])
    return flag_high_value(latest, threshold)
